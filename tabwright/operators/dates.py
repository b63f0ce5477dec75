"""Date conversion, search and sorting."""

from __future__ import annotations

import calendar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions import dates as grammar
from tabwright.functions.cells import is_date_shaped, text, trim_ws
from tabwright.functions.csvtext import render_line
from tabwright.operators.profiles import TOTAL, rates
from tabwright.plans.results import (
    FIELDS, OK, ROW_NO, JobResult, Routing, corrupt_text, data_columns, file_of, place_of, quoted, require_columns,
    structure_error,
)
from tabwright.plans.scale import computed_once, number_rows


def convert_date(df: DataFrame, column: str, row_no: str = ROW_NO) -> JobResult:
    """Rewrite one column to ``yyyy-MM-ddTHH:mm:ss``; all cells come out trimmed.

    An empty cell is kept and counts as converted.  Rows whose date no format
    reads are rejects with the original text, and so are ragged and unreadable rows.
    """
    require_columns(df, column)
    names = [name for name in data_columns(df) if name != row_no]
    kinds = dict(df.dtypes)
    trimmed = {name: trim_ws(text(f"`{name}`")) for name in names if kinds[name] == "string" and name != column}
    cell = trim_ws(text(f"`{column}`"))
    tagged = computed_once(
        df.withColumns(trimmed),
        {"_tw_date": cell, "_tw_iso": grammar.iso_text(grammar.parse_mixed(cell))},
    )
    broken = structure_error(df, len(names))
    fits = broken.isNull()
    good = fits & ((F.col("_tw_date") == "") | F.col("_tw_iso").isNotNull())
    rendered = render_line(names)

    def rejects(rows: DataFrame) -> DataFrame:
        return rows.withColumn(column, F.col("_tw_date")).select(
            file_of(df).alias("file"),
            (F.col(row_no) + 1 if row_no in df.columns else F.lit(None).cast("bigint")).alias("line"),
            F.coalesce(broken, F.lit("DATE_CONVERSION_ERROR")).alias("error_type"),
            F.col("_tw_date").alias("original"),
            F.coalesce(corrupt_text(df), rendered).alias("record"),
        )

    def summary(rows: DataFrame, ok: Column) -> DataFrame:
        counts = rows.agg(F.count("*").alias("processed"), F.count_if(ok).alias("converted"), F.count_if(~ok).alias("errors"))
        return rates(counts, "processed", "converted", "errors")

    routing = Routing(
        tagged, {OK: good},
        clean=lambda rows: rows.withColumn(column, F.coalesce("_tw_iso", F.lit(""))).select(*quoted(df.columns)),
        rejects=rejects, summary=lambda rows: summary(rows, F.col(OK)),
    )
    return JobResult(routing.clean(tagged.filter(good)), rejects(tagged.filter(~good)), summary(tagged, good), routing)


def convert_all_dates(df: DataFrame, row_no: str = ROW_NO) -> DataFrame:
    """Every ``dd/MM/yyyy`` cell that is a real date becomes an ISO date.

    ``_converted`` counts the converted cells of a row.
    """
    kinds = dict(df.dtypes)
    names = [name for name in data_columns(df) if kinds[name] == "string" and name != row_no]
    iso = {f"_tw_iso{place}": grammar.day_month_to_iso(text(f"`{name}`")) for place, name in enumerate(names)}
    if not iso:
        return df.withColumn("_converted", F.lit(0))
    count = sum((F.when(F.col(name).isNotNull(), 1).otherwise(0) for name in iso), F.lit(0))
    replaced = {name: F.coalesce(found, F.col(f"`{name}`")) for name, found in zip(names, iso)}
    return computed_once(df, iso).withColumns(replaced | {"_converted": count}).drop(*iso)


def _moment(df: DataFrame, column: str, fmt: str) -> Column:
    require_columns(df, column)
    return grammar.parser(fmt)(text(f"`{column}`"))


def _preview(df: DataFrame, row_no: str) -> Column:
    first = [name for name in data_columns(df) if name != row_no][:5]
    return F.concat_ws(" | ", *[text(f"`{name}`") for name in first])


def _too_short(df: DataFrame, column: str) -> Column:
    """The row ends before the date column."""
    if FIELDS not in df.columns:
        return F.lit(False)
    place = data_columns(df).index(column)
    return F.col(FIELDS) <= place


def find_extreme_date(df: DataFrame, column: str, oldest: bool, row_no: str = ROW_NO, fmt: str = "us12") -> DataFrame:
    """The oldest or newest row, with its file and place in the input, and the counters, as one row.

    The first row wins a tie.  One pass with partial aggregation; unread dates
    have a NULL rank, so they never win.
    """
    short = _too_short(df, column)
    place = place_of(df, row_no) if oldest else -place_of(df, row_no)
    seen = df.select(
        F.when(~short, _moment(df, column, fmt)).alias("_ts"), short.alias("_short"),
        place.alias("_place"), _preview(df, row_no).alias("_preview"), F.col(row_no).alias("_no"),
        file_of(df).alias("_of"), place_of(df, row_no).alias("_at"),
    )
    rank = F.when(F.col("_ts").isNotNull(), F.struct("_ts", "_place"))
    pick = F.min_by if oldest else F.max_by
    return seen.agg(
        pick(F.struct("_ts", "_no", "_preview", "_of", "_at"), rank).alias("_row"),
        F.count_if(~F.col("_short")).alias("processed"),
        F.count("_ts").alias("valid"),
        F.count_if(~F.col("_short") & F.col("_ts").isNull()).alias("invalid"),
        F.count_if("_short").alias("short_rows"),
    ).select(
        grammar.iso_text(F.col("_row._ts")).alias("date"), (F.col("_row._no") + 1).alias("line"),
        F.col("_row._preview").alias("preview"), "processed", "valid", "invalid", "short_rows",
        F.col("_row._of").alias("file"), F.col("_row._at").alias("ord"),
    )


def find_oldest(df: DataFrame, column: str, row_no: str = ROW_NO) -> DataFrame:
    return find_extreme_date(df, column, oldest=True, row_no=row_no)


def find_newest(df: DataFrame, column: str, row_no: str = ROW_NO) -> DataFrame:
    return find_extreme_date(df, column, oldest=False, row_no=row_no)


def find_latest(df: DataFrame, column: str, fmt: str = "mdy") -> DataFrame:
    """(latest, valid, invalid) over one table, ``fmt`` being ``mdy`` or ``iso``."""
    moment = _moment(df, column, fmt).alias("_ts")
    return df.select(moment).agg(
        grammar.iso_text(F.max("_ts")).alias("latest"),
        F.count("_ts").alias("valid"),
        F.count_if(F.col("_ts").isNull()).alias("invalid"),
    )


def _batch(df: DataFrame, column: str, fmt: str, file: str, pick, name: str) -> DataFrame:
    """Extreme per file and over all files (``TOTAL``), from a per-file partial result."""
    per_file = (
        df.select(F.col(file).alias("file"), _moment(df, column, fmt).alias("_ts"))
        .groupBy("file").agg(pick("_ts").alias("_ts"), F.count("_ts").alias("valid"))
    )
    label = F.when(F.grouping("file") == 1, F.lit(TOTAL)).otherwise(F.col("file"))
    return (
        per_file.rollup("file")
        .agg(label.alias("_label"), pick("_ts").alias("_ts"), F.sum("valid").alias("valid"))
        .select(F.col("_label").alias("file"), grammar.iso_text(F.col("_ts")).alias(name), "valid")
    )


def find_latest_batch(df: DataFrame, column: str, fmt: str = "mdy", file: str = "_file") -> DataFrame:
    return _batch(df, column, fmt, file, F.max, "latest")


def find_earliest_batch(df: DataFrame, column: str, fmt: str = "mdy", file: str = "_file") -> DataFrame:
    return _batch(df, column, fmt, file, F.min, "earliest")


def find_last_by_month(
    df: DataFrame, column: str, year: int, month: int, row_no: str = ROW_NO, fmt: str = "us12"
) -> DataFrame:
    """The latest row of a month, or else the row nearest to the month's end.

    One row: whether the month was hit, how many rows matched, the chosen row with its
    file and place in the input, and for a miss its whole days of distance and the side (``before``/``after``).
    Both candidates come out of one pass; the first row wins ties.
    """
    if not 1 <= month <= 12:
        raise ValueError("month must be between 1 and 12")
    last_day = calendar.monthrange(year, month)[1]
    target = F.lit(f"{year:04d}-{month:02d}-{last_day:02d} 23:59:59").cast("timestamp_ntz")
    seen = df.select(
        _moment(df, column, fmt).alias("_ts"), F.col(row_no).alias("_no"), place_of(df, row_no).alias("_place"),
        _preview(df, row_no).alias("_preview"), file_of(df).alias("_of"),
    )
    ts = F.col("_ts")
    inside = (F.year(ts) == year) & (F.month(ts) == month)
    distance = F.abs(F.timestamp_diff("SECOND", target, ts))
    row = F.struct("_ts", "_no", "_preview", "_of", "_place")
    picked = seen.agg(
        F.max_by(row, F.when(inside, F.struct(ts, -F.col("_place")))).alias("_hit"),
        F.min_by(row, F.when(ts.isNotNull(), F.struct(distance, F.col("_place")))).alias("_near"),
        F.count_if(inside).alias("matched"),
        F.count("_ts").alias("valid"),
    )
    chosen = F.coalesce("_hit", "_near")
    hit = F.col("_hit").isNotNull()
    away = F.abs(F.timestamp_diff("SECOND", target, F.col("_near._ts")))
    return picked.select(
        hit.alias("found"), "matched", "valid",
        grammar.iso_text(chosen.getField("_ts")).alias("date"),
        (chosen.getField("_no") + 1).alias("line"),
        chosen.getField("_preview").alias("preview"),
        F.when(~hit, F.floor(away / 86400)).alias("days_away"),
        F.when(~hit, F.when(F.col("_near._ts") < target, "before").otherwise("after")).alias("side"),
        chosen.getField("_of").alias("file"), chosen.getField("_place").alias("ord"),
    )


def sort_by_date(
    df: DataFrame, column: str, order: str = "desc", row_no: str = ROW_NO, fmt: str = "any", numbered: bool = False
) -> DataFrame:
    """Sort by parsed date, unread dates last, ties in input order.

    The input position is part of the range key, so a date shared by a third of
    the rows is still split over tasks.  ``numbered`` adds a global ``place``.
    """
    if order not in ("asc", "desc"):
        raise ValueError("order must be 'asc' or 'desc'")
    dated = df.withColumn("_tw_ts", _moment(df, column, fmt))
    by = F.col("_tw_ts").desc_nulls_last() if order == "desc" else F.col("_tw_ts").asc_nulls_last()
    keys = [by, place_of(df, row_no).asc()]
    found = number_rows(dated, keys, "place") if numbered else dated.orderBy(*keys)
    return found.drop("_tw_ts")


def check_relation_dates(df: DataFrame, columns: list[str], row_no: str = ROW_NO) -> JobResult:
    """ISO shape of date cells (not calendar validity); empty cells pass.  Rejects: (file, ord, line, field, value)."""
    require_columns(df, row_no, *columns)
    bad = [(name, (text(f"`{name}`") != "") & ~is_date_shaped(text(f"`{name}`"))) for name in columns]
    ok = F.lit(True)
    for _, wrong in bad:
        ok = ok & ~wrong
    found = F.filter(
        F.array(*[F.when(wrong, F.struct(F.lit(n).alias("field"), text(f"`{n}`").alias("value"))) for n, wrong in bad]),
        lambda pair: pair.isNotNull(),
    )
    place = [file_of(df).alias("file"), place_of(df, row_no).alias("ord"), (F.col(row_no) + 1).alias("line")]
    routing = Routing(
        df, {OK: ok, "_tw_found": found}, clean=lambda rows: rows,
        rejects=lambda rows: rows.select(*place, F.inline("_tw_found")),
        summary=lambda rows: rows.agg(F.count("*").alias("processed"), F.count_if(OK).alias("valid")),
    )
    summary = df.agg(F.count("*").alias("processed"), F.count_if(ok).alias("valid"))
    return JobResult(df.filter(ok), df.filter(~ok).select(*place, F.inline(found)), summary, routing)
