"""What was found in files before, kept in a folder and extended file by file.

A profile has one row per file: its lines, its first line and a mergeable sketch
of its different data lines.  A row counts for a file of the same length,
modification time and charset only, so a changed file is read again and no other
one is.  Files are told apart by their listing; no content is read for that.

Rows are only ever appended, by a committed write, so a lost run leaves nothing
half known and two runs side by side at worst keep a row twice.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.plans.scale import cut_lineage
from tabwright.sources.lines import file_list, ordinal, read_lines

# 2**14 registers: one standard error is 1.04 / 2**7, that is 0.8 % of the distinct lines.
SKETCH_BITS = 14
STATE = ("file", "size", "changed", "charset")
PROFILE = "file string, size bigint, changed timestamp, charset string, lines bigint, header string, sketch binary"


def file_states(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, file_ord, size, changed) of each entry of the list; a file without bytes has size 0."""
    listed = spark.read.format("binaryFile").load(list(dict.fromkeys(paths))).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("changed"))
    return file_list(spark, paths).join(listed, "file", "left").select(
        "file", "file_ord", F.coalesce("size", F.lit(0)).alias("size"), "changed")


def as_path(uri: str) -> str:
    """A file's URI as the readers take it: decoded, with glob characters taken literally."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", re.sub("^file:/+", "file:///", unquote(uri)))


def kept_table(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The table in the folder; made empty where there is none."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(folder)
    return spark.read.schema(schema).parquet(folder)


def profile_lines(lines: DataFrame) -> DataFrame:
    """(file, lines, header, sketch) of a line table; the sketch leaves line 1 out.

    The sketch makes this an object aggregate, which holds a file's first line
    without sorting; a file of any length reaches its reducer as one row per task.
    """
    return lines.groupBy("file").agg(
        F.count("*").alias("lines"),
        F.max(F.when(F.col("line_no") == 1, F.col("line"))).alias("header"),
        F.hll_sketch_agg(F.when(F.col("line_no") > 1, F.col("line")), F.lit(SKETCH_BITS)).alias("sketch"),
    )


def kept_profile(spark: SparkSession, paths: str | list[str], folder: str, charset: str | None = None) -> DataFrame:
    """Profile of every entry of the list, with ``file_ord``; only new and changed files are read.

    A file without a line has 0 ``lines`` and neither header nor sketch.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    states = cut_lineage(file_states(spark, paths).withColumn("charset", F.lit(charset or "")))
    known = kept_table(spark, folder, PROFILE).select(*STATE)
    missing = states.filter("size > 0").select(*STATE).distinct().join(known, list(STATE), "left_anti")
    fresh = [as_path(row["file"]) for row in missing.select("file").collect()]
    if fresh:
        profile = profile_lines(read_lines(spark, fresh, charset))
        rows = states.select(*STATE).distinct().join(profile, "file")
        rows.select(*STATE, "lines", "header", "sketch").write.mode("append").parquet(folder)
    known = spark.read.schema(PROFILE).parquet(folder).dropDuplicates(list(STATE))
    found = states.join(known, list(STATE), "left")
    return found.select("file", "file_ord", F.coalesce("lines", F.lit(0)).alias("lines"), "header", "sketch")


def top_lines(profile: DataFrame) -> DataFrame:
    """Line 1 of every file as a line table, for jobs that look at headers alone (H1, H2); no file is read."""
    found = profile.filter("lines > 0")
    first = found.agg(F.min("file_ord")).scalar()
    return found.select(
        "file", "file_ord", F.lit(1).cast("bigint").alias("line_no"), ordinal(F.col("file_ord"), F.lit(1)).alias("ord"),
        F.col("header").alias("line"), F.col("lines").alias("file_lines"), (F.col("file_ord") == first).alias("top_file"))
