"""Counts and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.operators.slices import repeated_headers
from tabwright.sources.lines import file_of_ordinal, is_top_line

TOTAL = "TOTAL"


def count_lines(lines: DataFrame) -> DataFrame:
    """Physical lines with the header, and data rows without it."""
    return lines.agg(
        F.count("*").alias("lines"),
        F.count_if(F.col("line_no") > 1).alias("data_rows"),
    )


def count_by_file(rows: DataFrame, file: str = "file", files: DataFrame | None = None) -> DataFrame:
    """(file, lines) per file and a ``TOTAL`` row.

    Files are counted first, so the total is a rollup of the small table.  Pass
    ``files`` (from ``file_list``) to also report files without a line.
    """
    counts = rows.groupBy(F.col(file).alias("file")).agg(F.count("*").alias("lines"))
    if files is not None:
        counts = files.join(counts, "file", "left").select("file", F.coalesce("lines", F.lit(0)).alias("lines"))
    total = F.when(F.grouping("file") == 1, F.lit(TOTAL)).otherwise(F.col("file"))
    return counts.rollup("file").agg(
        total.alias("name"), F.sum("lines").alias("lines")
    ).select(F.col("name").alias("file"), "lines")


def count_unique(lines: DataFrame, header: str = "skip", approximate: bool = False) -> DataFrame:
    """Distinct lines.

    ``skip`` leaves line 1 of every file out and returns one number; with
    ``approximate`` it is a sketch.  ``first`` reports, per file and in total, the
    lines read and the lines not seen in an earlier place; the very first header
    counts as seen, later headers only count as lines (so as duplicates).
    """
    if header == "skip":
        data = lines.filter("line_no > 1")
        if approximate:
            return data.agg(F.approx_count_distinct("line").alias("unique_lines"))
        return data.groupBy("line").agg(F.lit(1)).agg(F.count("*").alias("unique_lines"))
    if header != "first":
        raise ValueError("header must be 'skip' or 'first'")
    newly = (
        lines.filter((F.col("line_no") > 1) | is_top_line(lines))
        .groupBy("line").agg(F.min("ord").alias("ord"))
        .groupBy(file_of_ordinal(F.col("ord")).alias("file_ord")).agg(F.count("*").alias("unique_lines"))
    )
    totals = lines.groupBy("file", "file_ord").agg(F.count("*").alias("lines"))
    per_file = totals.join(newly, "file_ord", "left").select(
        "file", "lines", F.coalesce("unique_lines", F.lit(0)).alias("unique_lines")
    )
    name = F.when(F.grouping("file") == 1, F.lit(TOTAL)).otherwise(F.col("file"))
    return (
        per_file.rollup("file")
        .agg(name.alias("name"), F.sum("lines").alias("lines"), F.sum("unique_lines").alias("unique_lines"))
        .select(
            F.col("name").alias("file"), "lines", "unique_lines",
            (F.col("lines") - F.col("unique_lines")).alias("duplicates"),
        )
    )


def count_unique_kept(profile: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Distinct data lines of any set of files, out of their kept sketches: no file is read.

    The estimate of a union has a standard error of 0.8 % (``kept.SKETCH_BITS``).
    ``by`` names columns of the profile to unite files by; without it all are united.
    """
    estimate = F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("unique_lines")
    return profile.filter("sketch IS NOT NULL").groupBy(*(by or [])).agg(estimate)


def has_repeated_header(lines: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """(file, repeats): files whose header comes again, and how often; ``headers`` saves the scan for line 1."""
    return repeated_headers(lines, headers).groupBy("file").agg(F.count("*").alias("repeats"))


def rates(summary: DataFrame, whole: str, *parts: str) -> DataFrame:
    """Add ``<part>_percent`` of ``whole``, 0 for an empty input."""
    for part in parts:
        share = F.coalesce(F.try_divide(F.col(part) * 100.0, F.col(whole)), F.lit(0.0))
        summary = summary.withColumn(f"{part}_percent", F.round(share, 2))
    return summary
