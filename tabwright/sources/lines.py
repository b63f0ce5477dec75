"""Ordered, numbered lines of delimited files.

A line table has ``file``, ``file_ord``, ``line_no`` (1 is the header), ``ord``
and ``line``; read from files it also has ``file_lines``, the length of the file,
and ``top_file``, true for the first file with lines.  ``ord = file_ord * 2**40 + line_no`` keeps list order and line
order in one BIGINT, so first-seen jobs stay hash aggregates and the file can be
read back out of the number.

Line numbers need no global sort.  Opening the files counts the rows of every
file block in one narrow pass; prefix sums over that small table give each block
its offset, and reading adds the row's position inside its block.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabwright.functions.cells import trim_ws
from tabwright.plans import scale
from tabwright.plans.scale import cut_lineage, measured_bytes

FILE_SHIFT = 40
LINE_COLUMNS = ("file", "file_ord", "line_no", "ord", "line", "file_lines", "top_file")


def ordinal(file_ord: Column, line_no: Column) -> Column:
    return F.shiftleft(file_ord.cast("bigint"), FILE_SHIFT) + line_no.cast("bigint")


def file_of_ordinal(ord_: Column) -> Column:
    return F.shiftright(ord_, FILE_SHIFT)


def line_table(df: DataFrame, file: str, file_ord: str, line_no: str, line: str) -> DataFrame:
    """Use columns of any table as a line table."""
    return df.select(
        F.col(file).cast("string").alias("file"),
        F.col(file_ord).cast("bigint").alias("file_ord"),
        F.col(line_no).cast("bigint").alias("line_no"),
        ordinal(F.col(file_ord), F.col(line_no)).alias("ord"),
        F.col(line).alias("line"),
    )


def resolve_files(spark: SparkSession, paths: list[str]) -> list[str]:
    """Files behind each entry, in list order; a folder or glob opens in path order.

    One listing covers every entry that names a file; only folders and globs are
    listed by themselves.  A file may be listed twice, but not by two spellings.
    """
    listed = spark.read.text(list(dict.fromkeys(paths))).inputFiles()
    by_path: dict[str, set[str]] = {}
    for uri in listed:
        plain = unquote(uri)
        for name in (plain, re.sub("^[a-z0-9]+:(//[^/]*)?", "", plain)):
            by_path.setdefault(name, set()).add(uri)
    opened, owner = {}, {}
    for path in dict.fromkeys(paths):
        same = by_path.get(path, ())
        opened[path] = list(same) if len(same) == 1 else sorted(spark.read.text(path).inputFiles())
        for uri in opened[path]:
            if owner.setdefault(uri, path) != path:
                raise ValueError(f"{uri} is listed both by {owner[uri]!r} and by {path!r}")
    return [uri for path in paths for uri in opened[path]]


def file_list(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, file_ord), also for files without a single line."""
    # The scan names local files with a single slash.
    found = [re.sub("^file:/+", "file:/", uri) for uri in resolve_files(spark, paths)]
    rows = [(uri, place) for place, uri in enumerate(found)]
    return spark.createDataFrame(rows, "file string, file_ord bigint")


def _pin_split_planning(spark: SparkSession) -> None:
    """Both passes must see the same splits, also while executors come and go."""
    key = "spark.sql.files.minPartitionNum"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(spark.sparkContext.defaultParallelism))


def number_scan(spark: SparkSession, scan: DataFrame, paths: list[str]) -> DataFrame:
    """Number the rows of a file scan with ``_file``, ``_block`` and ``_id`` columns.

    ``_id`` must be monotonically_increasing_id() right on the scan.  The block
    table is counted here and now, once, and checkpointed, so every later action
    on the lines is a single pass.  It is broadcast when it was measured to be
    small; beyond that the join shuffles by (file, block), and no key holds more
    than one block.
    """
    files = file_list(spark, paths).withColumnRenamed("file", "_file")
    whole = Window.partitionBy("file_ord")
    earlier = whole.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = cut_lineage(
        scan.groupBy("_file", "_block")
        .agg(F.min("_id").alias("_first"), F.count("*").alias("_rows"))
        .join(files, "_file")
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .withColumn("file_lines", F.sum("_rows").over(whole))
    )
    first = blocks.agg(F.min("file_ord")).first()[0]
    blocks = blocks.withColumn("top_file", F.col("file_ord") == F.lit(first))
    if measured_bytes(blocks) <= scale.BROADCAST_BYTES:
        blocks = F.broadcast(blocks)
    position = F.col("_id") - F.col("_first")
    changed = F.raise_error(F.lit("file splits changed between the two passes")).cast("bigint")
    in_block = (position >= 0) & (position < F.col("_rows"))
    return (
        scan.join(blocks, ["_file", "_block"], "left")
        .withColumn("line_no", F.when(in_block, position + F.col("_offset") + 1).otherwise(changed))
        .withColumn("ord", ordinal(F.col("file_ord"), F.col("line_no")))
        .withColumnRenamed("_file", "file")
        .drop("_block", "_id", "_first", "_rows", "_offset")
    )


def without_cr(line: Column) -> Column:
    """The line without one CR at its end; cut by bytes, so bytes that are no UTF-8 stay as they are."""
    data = line.cast("binary")
    return F.when(line.endswith("\r"), F.substring(data, F.lit(1), F.octet_length(line) - 1).cast("string")).otherwise(line)


def scan_lines(spark: SparkSession, paths: list[str], charset: str | None = None, keep_cr: bool = False) -> DataFrame:
    """Raw lines with provenance; one trailing CR is taken off unless kept, quotes mean nothing.

    With ``charset`` (one in which a line feed is the byte 10, as ISO-8859-1) the bytes
    of the lines are decoded by it; without, they stay as they are.
    """
    if charset and charset.upper().startswith(("UTF-16", "UTF-32")):
        raise ValueError(f"lines cannot be told apart in {charset}: a line feed is more than one byte")
    _pin_split_planning(spark)
    raw = spark.read.option("lineSep", "\n").text(list(dict.fromkeys(paths)))
    line = F.col("value") if keep_cr else without_cr(F.col("value"))
    return raw.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        (F.decode(line.cast("binary"), charset) if charset else line).alias("line"),
    )


def with_position(scan: DataFrame) -> DataFrame:
    return scan.withColumn("_id", F.monotonically_increasing_id())


def read_lines(spark: SparkSession, paths: str | list[str], charset: str | None = None) -> DataFrame:
    """Line table of the files, numbered in list order, then position; decoded by ``charset`` if one is named.

    Opening the files counts their blocks in one job.  The count and every later
    read must cut the files alike, so ``spark.sql.files.minPartitionNum`` is set
    to the default parallelism for the session if it has no value; give it one to
    choose the splits yourself.  Splits that moved anyway fail the read.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    scan = with_position(scan_lines(spark, paths, charset))
    return number_scan(spark, scan, paths).select(*LINE_COLUMNS)


def is_top_line(lines: DataFrame) -> Column:
    """Whether a line is line 1 of the first file: the header a merge keeps."""
    if "top_file" in lines.columns:
        return (F.col("line_no") == 1) & F.col("top_file")
    return F.col("ord") == lines.filter("line_no = 1").select(F.min("ord")).scalar()


def first_line(lines: DataFrame) -> str:
    """Header text of the first file (one row to the driver); '' without lines."""
    row = lines.filter("line_no = 1").orderBy("ord").select("line").first()
    return row["line"] if row else ""


def manifest_entries(spark: SparkSession, path: str) -> DataFrame:
    """(ord, path) of the paths listed one per line; blank lines and ``#`` comments are skipped."""
    entries = read_lines(spark, path).select("ord", trim_ws(F.col("line")).alias("path"))
    return entries.filter((F.col("path") != "") & ~F.col("path").startswith("#"))


def read_manifest(spark: SparkSession, path: str) -> list[str]:
    """The listed paths in order, as the readers take them."""
    return [row["path"] for row in manifest_entries(spark, path).orderBy("ord").collect()]
