"""Header checks and repairs over line tables (one header line per file)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.cells import is_float, trim_ws
from tabwright.functions.csvtext import split_cells
from tabwright.operators.slices import headers_of
from tabwright.plans.models import TableModel, get_model
from tabwright.plans.scale import attach_per_file, computed_once
from tabwright.sources.lines import ordinal


def _joined(names: Column) -> Column:
    return F.array_join(F.array_sort(names), ",")


def check_header(lines: DataFrame, model: str | TableModel | None = None) -> DataFrame:
    """One row per file: names that come twice, missing and extra names, record count.

    ``status`` is ``duplicate`` before anything else, then ``mismatch`` against
    the model, else ``ok``.  Name lists are sorted and comma separated.
    """
    names = F.col("_names")
    # Equal names are neighbours once sorted, so wide lines stay cheap.
    in_order = F.array_sort(names)
    neighbours = F.zip_with(in_order, F.slice(in_order, F.lit(2), F.size(in_order)), lambda a, b: F.when(a == b, a))
    twice = F.array_distinct(F.array_compact(neighbours))
    if model is None:
        missing = extra = F.array().cast("array<string>")
    else:
        expected = F.array(*[F.lit(name) for name in get_model(model).columns])
        missing, extra = F.array_except(expected, names), F.array_except(names, expected)
    if "file_lines" in lines.columns:
        # Lines read from files know their file's length, so line 1 tells all.
        top = lines.filter("line_no = 1").select("file", F.col("line").alias("header"), (F.col("file_lines") - 1).alias("records"))
    else:
        records = lines.groupBy("file").agg(F.count_if(F.col("line_no") > 1).alias("records"))
        top = headers_of(lines).join(records, "file")
    status = (
        F.when(F.col("duplicates") != "", "duplicate")
        .when((F.size("_missing") > 0) | (F.size("_extra") > 0), "mismatch")
        .otherwise("ok")
    )
    return (
        computed_once(top, {"_names": split_cells(F.col("header"))})
        .select(
            "file", F.size(names).alias("n_columns"), "records", _joined(twice).alias("duplicates"),
            missing.alias("_missing"), extra.alias("_extra"),
        )
        .select(
            "file", "n_columns", "records", "duplicates",
            _joined(F.col("_missing")).alias("missing"), _joined(F.col("_extra")).alias("extra"),
            status.alias("status"),
        )
    )


def _looks_like_data(header: Column) -> Column:
    """Some cell is empty or a number, which no column name is."""
    return F.exists(split_cells(header), lambda cell: (trim_ws(cell) == "") | is_float(trim_ws(cell)))


def detect_missing_header(lines: DataFrame, expected: str | None = None) -> DataFrame:
    """(file, missing_header): line 1 is not the expected header, or looks like data."""
    header = F.col("header")
    missing = _looks_like_data(header) if expected is None else trim_ws(header) != F.lit(expected.strip())
    return headers_of(lines).select("file", missing.alias("missing_header"))


def add_header(lines: DataFrame, model: str | TableModel) -> DataFrame:
    """Put the model's header above files that lack one; other files pass through.

    A file lacks a header when line 1 is not the model's header and looks like
    data.  Lines of repaired files move down by one; ``header_added`` marks them.
    Files without any line stay absent.
    """
    wanted = F.lit(get_model(model).header)
    top = lines.filter("line_no = 1")
    lacks = (trim_ws(F.col("line")) != wanted) & _looks_like_data(F.col("line"))
    flags = top.filter(lacks).select("file", F.lit(True).alias("header_added"))
    added = F.coalesce("header_added", F.lit(False))
    body = attach_per_file(lines, flags).withColumn("header_added", added).withColumn(
        "line_no", F.col("line_no") + F.col("header_added").cast("bigint")
    )
    new = top.filter(lacks).withColumns({"line": wanted, "header_added": F.lit(True)})
    repaired = body.unionByName(new).withColumn("ord", ordinal(F.col("file_ord"), F.col("line_no")))
    if "file_lines" in lines.columns:
        longer = F.col("file_lines") + F.col("header_added").cast("bigint")
        repaired = repaired.withColumn("file_lines", longer)
    return repaired


def batch_add_headers(lines: DataFrame, model: str | TableModel, path: str) -> DataFrame:
    """``add_header`` for every file of a manifest, one output folder per file.

    Folders carry the place in the list too, so equal file names stay apart.
    Data lines are written under the model's header, blank ones included.  A file
    with a header of its own keeps it and so cannot join this output; such files
    are returned as (file, header) for the caller to look at, never rewritten.
    """
    from tabwright.sources.sinks import write_lines

    wanted = get_model(model).header
    repaired = add_header(lines, model)
    foreign = headers_of(repaired).filter(trim_ws(F.col("header")) != wanted)
    flags = foreign.select("file", F.lit(True).alias("_foreign"))
    fitting = attach_per_file(repaired, flags).filter("_foreign IS NULL AND line_no > 1")
    name = F.regexp_extract("file", "([^/]*)$", 1)
    write_lines(fitting.withColumn("file_name", name), path, wanted, partition_by=["file_ord", "file_name"], order_by="line_no")
    return foreign
