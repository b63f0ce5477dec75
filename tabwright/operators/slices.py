"""Filters and slices of line tables and record tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.cells import rtrim_ws, text, trim_ws
from tabwright.plans.results import CHUNK, CHUNK_SIZE, ROW_NO, JobResult, data_columns, require_columns, sound_rows
from tabwright.plans.scale import attach_per_file


def filter_equals(df: DataFrame, column: str, value: str, strict: bool = False) -> DataFrame:
    """Sound rows whose cell equals ``value`` exactly; a missing cell reads as ''.

    Ragged and unreadable rows are left to ``unsound_rows``, or fail with ``strict``.
    """
    require_columns(df, column)
    df = sound_rows(df, strict)
    if value == "" or dict(df.dtypes)[column] != "string":
        return df.filter(text(column) == value)
    return df.filter(F.col(column) == value)


def headers_of(lines: DataFrame) -> DataFrame:
    """(file, header): line 1 of every file."""
    return lines.filter("line_no = 1").select("file", F.col("line").alias("header"))


def drop_repeated_header(lines: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """Keep line 1, drop later lines exactly equal to it.

    ``headers`` (file, header), as a kept profile has them, saves the scan for line 1.
    """
    tagged = attach_per_file(lines, headers_of(lines) if headers is None else headers.select("file", "header").distinct())
    return tagged.filter((F.col("line_no") == 1) | (F.col("line") != F.col("header"))).drop("header")


def repeated_headers(lines: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """(file, line_no) of later lines equal to line 1 once trailing white space is off; ``headers`` as above."""
    tagged = attach_per_file(lines, headers_of(lines) if headers is None else headers.select("file", "header").distinct())
    same = rtrim_ws(F.col("line")) == rtrim_ws(F.col("header"))
    return tagged.filter((F.col("line_no") > 1) & same).select("file", "line_no")


def is_blank_line(line: Column) -> Column:
    """Nothing left after white space and then outer commas are taken off."""
    return F.btrim(trim_ws(line), F.lit(",")) == ""


def drop_blank_lines(lines: DataFrame) -> DataFrame:
    return lines.filter(~is_blank_line(F.col("line")))


def sanitize_text(lines: DataFrame) -> JobResult:
    """Blank lines out; the byte order mark is already off and writers end every line."""
    blank = is_blank_line(F.col("line"))
    summary = lines.agg(
        F.count("*").alias("total_lines"),
        F.count_if(blank).alias("blank_removed"),
        F.count_if(~blank).alias("final_lines"),
    ).withColumn("data_rows", F.greatest(F.col("final_lines") - 1, F.lit(0)))
    return JobResult(clean=lines.filter(~blank), rejects=lines.filter(blank), summary=summary)


def delete_from_row(records: DataFrame, row: int, row_no: str = ROW_NO) -> DataFrame:
    """Keep rows before ``row`` (the header is row 1, the first record row 2), cells trimmed.

    Rows count in each file; ragged and unreadable rows are skipped.
    """
    if row <= 1:
        raise ValueError("row must be above 1: row 1 is the header")
    require_columns(records, row_no)
    strings = {name for name, kind in records.dtypes if kind == "string"}
    trimmed = {name: trim_ws(F.col(f"`{name}`")) for name in data_columns(records) if name in strings}
    return sound_rows(records, row_no=row_no).filter(F.col(row_no) + 1 < row).withColumns(trimmed)


def head(lines: DataFrame, n: int = 10) -> DataFrame:
    """Header and first ``n`` data lines of every file."""
    return lines.filter(F.col("line_no") <= n + 1)


def tail(lines: DataFrame, n: int = 10, whole_files: bool = False) -> DataFrame:
    """Header and last ``n`` data lines of every file.

    Lines straight from ``read_lines`` know their file's length: with
    ``whole_files`` this is a plain filter (not to be used once lines were
    dropped).  Otherwise the length of each file is attached; lines are not moved.
    """
    if whole_files:
        require_columns(lines, "file_lines")
        return lines.filter((F.col("line_no") == 1) | (F.col("line_no") > F.col("file_lines") - n))
    lengths = lines.groupBy("file").agg(F.max("line_no").alias("_lines"))
    tagged = attach_per_file(lines, lengths)
    return tagged.filter((F.col("line_no") == 1) | (F.col("line_no") > F.col("_lines") - n)).drop("_lines")


def inspect_line(lines: DataFrame, target: int, context: int = 5) -> DataFrame:
    """Line ``target`` with ``context`` lines on both sides; the target is flagged."""
    near = lines.filter(F.col("line_no").between(target - context, target + context))
    return near.withColumn("is_target", F.col("line_no") == target)


def split_chunks(records: DataFrame, size: int, row_no: str = ROW_NO) -> DataFrame:
    """Add ``_chunk_id`` from 1: consecutive runs of ``size`` records of a file.

    Chunks never mix files; ``write_chunks`` keeps equal numbers of different files apart.
    """
    if size < 1:
        raise ValueError("size must be a positive integer")
    require_columns(records, row_no)
    return records.withColumn(CHUNK, F.expr(f"(`{row_no}` - 1) div {size} + 1").alias(CHUNK, metadata={CHUNK_SIZE: size}))
