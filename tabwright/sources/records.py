"""Delimited records: string cells, header names, ragged rows kept and marked."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.cells import text, trim_ws
from tabwright.functions.csvtext import field_count
from tabwright.plans.results import CORRUPT, FIELDS, ROW_NO
from tabwright.plans.scale import computed_once
from tabwright.sources import lines as line_source
from tabwright.sources import quoted


def record_schema(names: list[str]) -> T.StructType:
    fields = [T.StructField(name, T.StringType()) for name in (*names, CORRUPT)]
    return T.StructType(fields)


def _ddl(schema: T.StructType) -> str:
    return ", ".join("`" + field.name.replace("`", "``") + "` STRING" for field in schema.fields)


def csv_options(strict: bool) -> dict[str, str]:
    return {
        "escape": '"',
        "mode": "FAILFAST" if strict else "PERMISSIVE",
        "emptyValue": "",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        "columnNameOfCorruptRecord": CORRUPT,
        # A record may come with the line breaks of its quoted cells.
        "lineSep": "\n",
    }


def parse_lines(
    lines: DataFrame, names: list[str], strict: bool = False, trim: bool = False, header: bool = True
) -> DataFrame:
    """Parse a line table into records; line 1 of every file is its header.

    A row whose width differs from the header keeps the cells that fit, has its
    raw text in ``_corrupt`` and its real width in ``_n_fields``.  A row with bytes
    that are no UTF-8 has them in ``_corrupt`` as they stand.  A line with an
    odd number of quotes is half of a record with a line break in quotes (read
    such files with ``multi_line``) and is marked in ``_corrupt`` too.  With
    ``strict`` such rows fail the job.
    """
    data = lines.filter("line_no > 1") if header else lines
    schema = record_schema(names)
    if strict:
        schema = T.StructType(schema.fields[:-1])
    parsed = computed_once(
        data.select("file", "line_no", "ord", "line"),
        {"_cells": F.from_csv("line", _ddl(schema), csv_options(strict))},
    )
    cells = [text(F.col("_cells").getField(name)) for name in names]
    halved = F.contains(F.col("line"), F.lit('"')) & (F.regexp_count("line", F.lit('"')) % 2 == 1)
    garbled = ~F.is_valid_utf8(F.col("line"))
    if strict:
        undecodable = F.raise_error(F.lit("a record has bytes that are no UTF-8: name its charset"))
        broken = F.raise_error(F.lit("a record has a line break in quotes: read its file with multi_line"))
        corrupt = F.when(garbled, undecodable.cast("string")).when(halved, broken.cast("string"))
    else:
        corrupt = F.coalesce(F.col("_cells").getField(CORRUPT), F.when(halved | garbled, F.col("line")))
        corrupt = F.when(garbled, F.col("line")).otherwise(corrupt)
    # A row that fits needs no counting.
    width = F.when(corrupt.isNull(), F.lit(len(names))).otherwise(field_count(F.col("line")))
    return parsed.select(
        *[(trim_ws(cell) if trim else cell).alias(name) for name, cell in zip(names, cells)],
        (F.col("line_no") - (1 if header else 0)).alias(ROW_NO),
        F.col("file").alias("_file"),
        F.col("ord").alias("_ord"),
        width.alias(FIELDS),
        corrupt.alias(CORRUPT),
    )


def header_names(header: str) -> list[str]:
    """Names of a header line; a name that comes again gets its number (``a``, ``a_2``), ``check_header`` reports it."""
    names, used = [], set()
    for name in next(csv.reader([header]), []):
        free, number = name, 2
        while free.lower() in used:
            free, number = f"{name}_{number}", number + 1
        used.add(free.lower())
        names.append(free)
    return names


def read_records(
    spark: SparkSession,
    paths: str | list[str],
    header: bool = True,
    names: list[str] | None = None,
    strict: bool = False,
    trim: bool = False,
    multi_line: bool = False,
    quoted_breaks: bool = False,
    charset: str | None = None,
) -> DataFrame:
    """Records of the files with ``_row_no`` from 1 in each file.

    Names come from the first file's header unless given, and every file is read
    under them (``check_header`` tells files apart).  Files split freely
    unless ``multi_line`` is asked for: the CSV reader then reads quoted line breaks, at
    the price of one task per file.  ``quoted_breaks`` reads them in files that split
    (see ``sources.quoted``), with one more pass over the lines.

    Bytes that are no UTF-8 make a record unreadable (``ENCODING_ERROR``), unless
    ``charset`` names what they are.  ``multi_line`` cannot tell such records.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if multi_line and (charset or quoted_breaks):
        raise ValueError("multi_line reads by itself: use quoted_breaks, which can be given a charset")
    scan = line_source.scan_lines(spark, paths, charset).filter("line != ''")
    if names is None:
        # One small job per file until one has a line, in list and path order.
        files = line_source.resolve_files(spark, paths)
        tops = (line_source.scan_lines(spark, [file], charset).filter("_block = 0 AND line != ''").first() for file in files)
        top = next((row for row in tops if row), None)
        if top is None:
            raise ValueError("no file has a header line")
        names = header_names(top["line"]) if header else []
        if not header:
            names = [f"c{place}" for place in range(1, len(header_names(top["line"])) + 1)]
        if trim:
            names = [name.strip() for name in names]
    if multi_line:
        return _read_multi_line(spark, paths, names, header, strict, trim)
    if quoted_breaks:
        return parse_lines(quoted.scan_quoted(spark, paths, charset), names, strict=strict, trim=trim, header=header)
    numbered = line_source.number_scan(spark, line_source.with_position(scan), paths)
    return parse_lines(numbered, names, strict=strict, trim=trim, header=header)


def _read_multi_line(spark, paths, names, header, strict, trim) -> DataFrame:
    line_source._pin_split_planning(spark)
    raw = (
        spark.read.schema(record_schema(names)).options(**csv_options(strict))
        .option("multiLine", True).option("header", header).csv(list(dict.fromkeys(paths)))
    )
    scan = line_source.with_position(
        raw.select(
            *[F.col(f"`{name}`") for name in (*names, CORRUPT)],
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
        )
    )
    numbered = line_source.number_scan(spark, scan, paths)
    cells = [text(F.col(f"`{name}`")) for name in names]
    width = F.when(F.col(CORRUPT).isNull(), F.lit(len(names))).otherwise(field_count(F.col(CORRUPT)))
    return numbered.select(
        *[(trim_ws(cell) if trim else cell).alias(name) for name, cell in zip(names, cells)],
        F.col("line_no").alias(ROW_NO),
        F.col("file").alias("_file"),
        F.col("ord").alias("_ord"),
        width.alias(FIELDS),
        CORRUPT,
    )
