"""Merging, deduplication and positional comparison."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabwright.functions.cells import text, trim_ws
from tabwright.functions.csvtext import render_line
from tabwright.plans.results import (
    ROW_NO, JobResult, data_columns, file_of, is_ragged, is_undecodable, is_unreadable, quoted, require_columns, sound_rows,
)
from tabwright.plans import scale
from tabwright.plans.scale import cut_lineage, measured_bytes, number_rows
from tabwright.sources.kept import as_path, file_states, kept_table
from tabwright.sources.lines import FILE_SHIFT, first_line, is_top_line, read_lines

# Positions that ``compare`` sums up together.
RUN_LINES = 4096


def merge(lines: DataFrame) -> DataFrame:
    """All data lines under the first file's line 1; other first lines go unchecked."""
    return lines.filter((F.col("line_no") > 1) | is_top_line(lines))


def merge_dedup(lines: DataFrame, ordered: bool = False) -> DataFrame:
    """``merge`` with each distinct line once, at its first place.

    Returns (line, is_header, ord).  The header is its own group, so a data line
    equal to it is kept once.  Lines are hash-aggregated before the shuffle, so a
    line with many copies reaches its reducer once per task.
    """
    found = (
        merge(lines)
        .groupBy("line", (F.col("line_no") == 1).alias("is_header"))
        .agg(F.min("ord").alias("ord"))
    )
    return found.orderBy("ord") if ordered else found


GROWN_FILES = "step string, file string, file_ord bigint, size bigint, changed timestamp, has_lines boolean"
GROWN_LINES = "line string, is_header boolean, ord bigint, digest bigint"


def merge_dedup_grown(spark: SparkSession, paths: list[str], folder: str) -> DataFrame:
    """``merge_dedup`` of a list of files that grows at its end; what was seen is kept in the folder.

    While the files merged before still stand unchanged at the head of the list,
    only those behind them are read.  Kept lines are read once and stay in their
    tasks, but for those whose digest came again: equality is decided on these.
    Any other list is merged anew.

    Each call that finds new files writes a step of lines, then names it in the
    table of files.  Steps that are not named (of a run that was lost) are not read.
    """
    kept = kept_table(spark, f"{folder}/files", GROWN_FILES)
    states = cut_lineage(file_states(spark, paths))
    steps = _steps_of_the_head(kept, states)
    seen = kept.filter(F.col("step").isin(steps))
    base = seen.count()
    added = [as_path(row["file"]) for row in states.filter(F.col("file_ord") >= base).orderBy("file_ord").collect()]
    if added:
        step = uuid.uuid4().hex
        lines = read_lines(spark, added).withColumn("ord", F.col("ord") + (base << FILE_SHIFT))
        if seen.filter("has_lines").limit(1).count():
            lines = lines.withColumn("top_file", F.lit(False))
        found = merge_dedup(lines)
        if steps:
            found = found.join(_met_before(lines, _grown_lines(spark, folder, steps)), ["line", "is_header"], "left_anti")
        found = found.select("line", "is_header", "ord", F.xxhash64("line").alias("digest"))
        found.write.option("compression", "zstd").parquet(f"{folder}/lines/step={step}")
        named = states.filter(F.col("file_ord") >= base).select(
            F.lit(step).alias("step"), "file", "file_ord", "size", "changed", (F.col("size") > 0).alias("has_lines"))
        named.coalesce(1).write.mode("append").parquet(f"{folder}/files")
        steps = [*steps, step]
    return _grown_lines(spark, folder, steps).drop("digest")


def _steps_of_the_head(kept: DataFrame, states: DataFrame) -> list[str]:
    """Kept steps that together cover the head of the list, file by file; one row per step comes to the driver.

    A step starts where another one ends.  Of steps over the same files any will do.
    """
    same = (F.col("k.file") == F.col("s.file")) & (F.col("k.size") == F.col("s.size")) & F.col("k.changed").eqNullSafe(F.col("s.changed"))
    held = kept.alias("k").join(states.alias("s"), (F.col("k.file_ord") == F.col("s.file_ord")) & same, "left")
    spans = held.groupBy("k.step").agg(
        F.min("k.file_ord").alias("start"), (F.max("k.file_ord") + 1).alias("end"), F.bool_and(F.col("s.file").isNotNull()).alias("holds"))
    next_step = {row["start"]: row for row in spans.filter("holds").orderBy("end", "step").collect()}
    steps, at = [], 0
    while at in next_step:
        steps.append(next_step[at]["step"])
        at = next_step[at]["end"]
    return steps


def _grown_lines(spark: SparkSession, folder: str, steps: list[str]) -> DataFrame:
    return spark.read.schema(GROWN_LINES).parquet(*[f"{folder}/lines/step={step}" for step in steps])


def _met_before(lines: DataFrame, kept: DataFrame) -> DataFrame:
    """Kept lines whose digest is among those of the new lines.

    Digests are computed once; where they are measured to be few they go to the kept lines, not the reverse.
    """
    digests = cut_lineage(lines.select(F.xxhash64("line").alias("digest")).distinct())
    if measured_bytes(digests) <= scale.BROADCAST_BYTES:
        digests = F.broadcast(digests)
    return kept.join(digests, "digest", "left_semi").select("line", "is_header")


def merge_dedup_sorted(lines: DataFrame, numbered: bool = False) -> DataFrame:
    """Distinct lines in binary order, the header first.

    Returns (line, is_header), with a global ``place`` from 1 when ``numbered``.
    """
    found = merge(lines).select("line", (F.col("line_no") == 1).alias("is_header")).distinct()
    order = [F.desc("is_header"), F.asc("line")]
    return number_rows(found, order, "place") if numbered else found.orderBy(*order)


def merge_dedup_mixed(lines: DataFrame, expected_header: str | None = None) -> DataFrame:
    """Distinct data lines of files with and without header, under one header.

    Line 1 of a file is dropped only where it equals the header.  Returns
    (line, is_header, ord); the header row has ``ord`` -1.
    """
    header = first_line(lines) if expected_header is None else expected_header
    header = header.lstrip("\ufeff").strip()
    bare = trim_ws(F.regexp_replace("line", "^\ufeff", ""))
    data = (
        lines.filter(~((F.col("line_no") == 1) & (bare == header)))
        .groupBy("line").agg(F.min("ord").alias("ord"))
        .select("line", F.lit(False).alias("is_header"), "ord")
    )
    top = lines.sparkSession.range(1).select(
        F.lit(header).alias("line"), F.lit(True).alias("is_header"), F.lit(-1).cast("bigint").alias("ord")
    )
    return top.unionByName(data)


def merge_records_dedup(tables: list[DataFrame], strict: bool = False) -> DataFrame:
    """Distinct sound records of several tables of the same width, names from the first.

    Ragged and unreadable rows are left to ``unsound_rows``, or fail with ``strict``.
    """
    if not tables:
        raise ValueError("no tables to merge")
    names = data_columns(tables[0])
    same = [sound_rows(table, strict).select(*quoted(data_columns(table))).toDF(*names) for table in tables]
    return reduce(DataFrame.union, same).distinct()


def dedup_records(records: DataFrame, order_by: str | None = None, strict: bool = False) -> DataFrame:
    """Distinct sound records over all data columns; with ``order_by`` the first place is kept.

    Ragged and unreadable rows are left to ``unsound_rows``, or fail with ``strict``.
    """
    records = sound_rows(records, strict, row_no=order_by or ROW_NO)
    names = [name for name in data_columns(records) if name != order_by]
    if order_by is None:
        return records.select(*quoted(names)).distinct()
    require_columns(records, order_by)
    return records.groupBy(*quoted(names)).agg(F.min(order_by).alias(order_by))


def dedup_by_key(
    records: DataFrame,
    keys: list[str],
    order_by: str,
    keep: str = "last",
    strict: bool = False,
    row_no: str = ROW_NO,
) -> JobResult:
    """One row per key, the last one by ``order_by`` (put-item behaviour).

    Tolerant mode sends rows of the wrong width, unreadable rows and rows with an
    empty key cell to ``rejects``.  With ``strict`` an empty cell is a key like any
    other, and a row of the wrong width or an unreadable one fails the job.
    ``order_by`` must be unique.

    The rank filter is applied inside every task before the shuffle, so a key
    with a third of all rows sends one row per task.
    """
    require_columns(records, order_by, *keys)
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    names = data_columns(records)
    width = len([name for name in names if name not in (order_by, row_no)])
    empty = reduce(lambda a, b: a | b, [text(F.col(f"`{key}`")) == "" for key in keys])
    reason = (
        F.lit(None).cast("string") if strict else
        F.when(is_undecodable(records), "ENCODING_ERROR").when(is_ragged(records, width), "LENGTH_MISMATCH")
        .when(is_unreadable(records, width), "CSV_PARSE_ERROR")
        .when(empty, "EMPTY_KEY")
    )
    if strict:
        records = sound_rows(records, strict, row_no=row_no if row_no in names else order_by)
    tagged = records.withColumn("_tw_reason", reason)
    order = F.desc(order_by) if keep == "last" else F.asc(order_by)
    place = F.row_number().over(Window.partitionBy(*quoted(keys)).orderBy(order))
    sound = tagged.filter("_tw_reason IS NULL").drop("_tw_reason")
    clean = sound.withColumn("_tw_place", place).filter("_tw_place = 1").drop("_tw_place")
    rejects = tagged.filter("_tw_reason IS NOT NULL").select(
        file_of(records).alias("file"),
        (F.col(row_no) if row_no in records.columns else F.col(order_by)).alias("line"),
        F.col("_tw_reason").alias("error_type"),
        render_line([name for name in names if name not in (order_by, row_no)]).alias("record"),
    )
    # One row per distinct key carries all counters through a single aggregate.
    summary = (
        tagged.groupBy(*quoted(keys)).agg(
            F.count("*").alias("_rows"), F.count("_tw_reason").alias("_errors")
        )
        .agg(
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("processed"),
            F.count_if(F.col("_rows") > F.col("_errors")).alias("unique"),
            F.coalesce(F.sum("_errors"), F.lit(0)).alias("errors"),
        )
        .withColumn("duplicates", F.expr("processed - `unique` - errors"))
    )
    return JobResult(clean=clean, rejects=rejects, summary=summary)


def run_digests(df: DataFrame, on: str, value: str, run: int) -> DataFrame:
    """(_run, _rows, _first, _second): number and two 64-bit digests of the rows of each run of positions."""
    place = F.col(on).cast("bigint")
    digest = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), place, text(value)))
    return df.groupBy(F.floor(place / run).alias("_run")).agg(
        F.count("*").alias("_rows"), digest(1).alias("_first"), digest(2).alias("_second"))


def differing_runs(left: DataFrame, right: DataFrame, on: str, value: str, run: int) -> DataFrame:
    """(_run) of the runs whose digests differ; rows without a position always count as differing."""
    mine, other = run_digests(left, on, value, run), run_digests(right, on, value, run).withColumnsRenamed(
        {"_rows": "_rows2", "_first": "_first2", "_second": "_second2"})
    same = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"{name}2")) for name in ("_rows", "_first", "_second")])
    return mine.join(other, "_run", "full").filter(~same).select("_run")


def compare(
    left: DataFrame, right: DataFrame, on: str, value: str, n: int | None = None, exact: bool = True, run: int = RUN_LINES
) -> DataFrame:
    """Positions whose values differ, a missing side read as ''; ``on`` must be unique per side.

    With ``n`` only positions up to ``n`` take part (filtered before the join).  The
    join shuffles both sides in full.  With ``exact=False`` each run of ``run``
    positions is summed up first, inside the tasks that read it, and only the rows of
    runs whose sums differ are shuffled: two tables that agree nearly everywhere cost
    two narrow passes.  Equal sums (row count and 128 bits) are taken as equal runs.
    The sums are computed when the plan is built.
    """
    if not exact:
        runs = cut_lineage(differing_runs(left, right, on, value, run))
        small = measured_bytes(runs) <= scale.BROADCAST_BYTES
        left, right = (_rows_of_runs(df, runs, on, run, small) for df in (left, right))

    def side(df: DataFrame, name: str) -> DataFrame:
        kept = df if n is None else df.filter(F.col(on) <= n)
        return kept.select(on, F.col(value).alias(name))

    pairs = side(left, "left_value").join(side(right, "right_value"), on, "full")
    a, b = text("left_value"), text("right_value")
    return pairs.select(on, a.alias("left_value"), b.alias("right_value")).filter("left_value <> right_value")


def _rows_of_runs(df: DataFrame, runs: DataFrame, on: str, run: int, small: bool) -> DataFrame:
    """Rows of the named runs, and rows without a position; nothing moves if the runs can be broadcast."""
    wanted = runs.filter("_run IS NOT NULL").withColumn("_differs", F.lit(True))
    tagged = df.withColumn("_run", F.floor(F.col(on).cast("bigint") / run))
    met = tagged.join(F.broadcast(wanted) if small else wanted, "_run", "left")
    return met.filter(F.col("_differs") | F.col("_run").isNull()).select(*quoted(df.columns))


def compare_first_n(left: DataFrame, right: DataFrame, n: int = 100) -> JobResult:
    """Compare two one-file line tables over their first ``n`` data lines.

    ``clean`` holds the differences (line_no, left_value, right_value) with line 1
    as the first data line, ``summary`` whether headers agree and how many differ.
    Each side is read once: the headers are line 0 of the same comparison.
    """
    def top(lines: DataFrame) -> DataFrame:
        return lines.filter(F.col("line_no") <= n + 1).select((F.col("line_no") - 1).alias("line_no"), "line")

    found = compare(top(left), top(right), "line_no", "line")
    data = F.col("line_no") > 0
    summary = found.agg(
        (F.count_if(~data) == 0).alias("headers_equal"), F.count_if(data).alias("differences")
    )
    return JobResult(clean=found.filter(data), rejects=found.limit(0), summary=summary)
