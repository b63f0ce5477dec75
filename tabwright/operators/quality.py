"""Validation and sanitisation against table models, with rejects routed aside.

Each job tags a row with an array of problems in one narrow projection.  Rows
without problems are clean, the others become one reject row per problem, and
the summary is a partial aggregate: nothing here shuffles rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions import cells
from tabwright.functions.cells import key_text, text, trim_ws
from tabwright.functions.csvtext import render_line
from tabwright.operators.profiles import rates
from tabwright.plans.models import MOROSOS, TableModel, get_model
from tabwright.plans.results import (
    CORRUPT, FIELDS, OK, ROW_NO, JobResult, Routing, corrupt_text, data_columns, file_of, is_undecodable, is_unreadable, place_of, require_columns, structure_error,
)

# --- fixed values: key texts of unreadable keys ---
NO_TABLE_KEY = "INVALID_DYNAMO_KEY"
NO_RESUME_KEY = "INVALID_SQL_KEY"
RESUME_COLUMNS = ("IdCliente", "IdTransmit", "NroDoc")

PROBLEMS = "_tw_problems"
_PROBLEM = "struct<kind:string,field:string,value:string,details:string>"


def _problem(kind: str, details: Column, field: str | None = None, value: Column | None = None) -> Column:
    return F.struct(
        F.lit(kind).alias("kind"),
        F.lit(field).cast("string").alias("field"),
        (F.lit(None).cast("string") if value is None else value).alias("value"),
        details.alias("details"),
    )


def _problems(checks: list[tuple[Column, Column]]) -> Column:
    """Array of the problems whose condition holds."""
    if not checks:
        return F.array().cast(f"array<{_PROBLEM}>")
    found = F.array(*[F.when(bad, problem) for bad, problem in checks])
    return F.filter(found, lambda problem: problem.isNotNull())


def _cell(df: DataFrame, name: str) -> Column:
    return text(F.col(f"`{name}`"))


def _width_problem(df: DataFrame, width: int, kind: str) -> list[tuple[Column, Column]]:
    """Ragged rows, then rows whose width fits but whose text could not be read, then those of other bytes than UTF-8."""
    if FIELDS not in df.columns:
        return []
    garbled = is_undecodable(df)
    bad = (F.col(FIELDS) != width) & ~garbled
    details = F.concat(F.col(FIELDS).cast("string"), F.lit(f" cells under {width} columns"))
    checks = [(bad, _problem(kind, details))]
    if CORRUPT in df.columns:
        checks.append((~bad & ~garbled & F.col(CORRUPT).isNotNull(), _problem("PARSE_ERROR", F.lit("unreadable record"))))
        checks.append((garbled, _problem("ENCODING_ERROR", F.lit("the bytes are no UTF-8; the record shows them in hex"))))
    return checks


def _ok(checks: list[tuple[Column, Column]]) -> Column:
    """All checks pass; short-circuits, so clean rows never build the array."""
    return reduce(lambda a, b: a & b, [~bad for bad, _ in checks], F.lit(True))


def table_key(df: DataFrame, model: TableModel) -> Column:
    return key_text(list(model.keys), [_cell(df, name) for name in model.keys])


def resume_key(df: DataFrame) -> Column:
    """``{IdCliente,IdTransmit,NroDoc}`` text; NULL where an id is no 32-bit integer."""
    client, transmit, document = (_cell(df, name) for name in RESUME_COLUMNS)
    parts = [client.try_cast("int").cast("string"), transmit.try_cast("int").cast("string"), document]
    return F.when(cells.is_int32(client) & cells.is_int32(transmit), key_text(list(RESUME_COLUMNS), parts))


def _keys(df: DataFrame, model: TableModel | None) -> list[Column]:
    have = model is not None and all(name in df.columns for name in model.keys)
    table = table_key(df, model) if have else F.lit(NO_TABLE_KEY)
    resumable = all(name in df.columns for name in RESUME_COLUMNS)
    resume = F.coalesce(resume_key(df), F.lit(NO_RESUME_KEY)) if resumable else F.lit(NO_RESUME_KEY)
    return [table.alias("table_key"), resume.alias("resume_key")]


def _record_text(df: DataFrame, names: list[str]) -> Column:
    rendered = render_line(names)
    return F.coalesce(corrupt_text(df), rendered)


def _reject_rows(
    df: DataFrame, problems: Column, names: list[str], row_no: str, model: TableModel | None
) -> DataFrame:
    """One row per problem: file, ord, line, error_type, field, value, details, keys, record."""
    line = F.col(row_no) + 1 if row_no in df.columns else F.lit(None).cast("bigint")
    order = place_of(df, row_no) if row_no in df.columns or "_ord" in df.columns else F.lit(None).cast("bigint")
    return (
        df.select(
            file_of(df).alias("file"), order.alias("ord"), line.alias("line"), *_keys(df, model),
            _record_text(df, names).alias("record"), F.explode(problems).alias("_p"),
        )
        .select(
            "file", "ord", "line", F.col("_p.kind").alias("error_type"), F.col("_p.field").alias("field"),
            F.col("_p.value").alias("value"), F.col("_p.details").alias("details"),
            "table_key", "resume_key", "record",
        )
    )


def _data_names(df: DataFrame, row_no: str) -> list[str]:
    return [name for name in data_columns(df) if name != row_no]


def _numeric_checks(
    df: DataFrame, model: TableModel, rule: str, by: str, names: list[str]
) -> list[tuple[Column, Column]]:
    """(bad, problem) per numeric field, found by name or by position."""
    valid = cells.number_rule(rule)
    checks = []
    for field in model.numeric:
        if by == "position":
            place = model.position(field)
            if place >= len(names):
                continue
            source = names[place]
        elif field in names:
            source = field
        else:
            continue
        raw = _cell(df, source)
        value = trim_ws(raw)
        # The scientific rule alone does not trim for itself.
        bad = ~valid(value if rule == "scientific" else raw)
        details = F.concat(F.lit(f"{field} holds no number: "), value)
        checks.append((bad, _problem("INVALID_NUMERIC", details, field, value)))
    return checks


def _route(
    df: DataFrame, width: list, other: list, names: list[str], row_no: str,
    model: TableModel | None, skipped: bool = False, trim: bool = False,
) -> JobResult:
    """Split on the checks; a row of bad structure is not looked at further.

    With ``trim`` cells come out trimmed; only what passed the checks, or failed
    them, is trimmed, so the checks themselves must read raw cells.
    """
    trimmed = {name: trim_ws(_cell(df, name)) for name in names} if trim else {}
    sound, fine = _ok(width), _ok(other)
    clean = df.filter(sound & fine).withColumns(trimmed)
    found = _problems(other)
    if skipped:
        mark = _problem("SKIPPED", F.lit("left out: a numeric field holds no number"))
        found = F.concat(found, F.array(mark))
    bad = df.filter(~(sound & fine)).withColumns(trimmed)
    problems = F.when(sound, found).otherwise(_problems(width)) if width else found
    rejects = _reject_rows(bad, problems, names, row_no, model)
    def summary(rows: DataFrame, sound: Column, ok: Column) -> DataFrame:
        counts = rows.agg(
            F.count("*").alias("processed"),
            F.count_if(ok).alias("valid"),
            F.count_if(sound & ~ok).alias("invalid_numeric"),
            F.count_if(~sound).alias("irreparable"),
        )
        return rates(counts, "processed", "valid", "invalid_numeric", "irreparable")

    routing = Routing(
        df, {OK: sound & fine, "_tw_sound": sound, PROBLEMS: F.when(~(sound & fine), problems)},
        clean=lambda rows: rows.withColumns(trimmed),
        rejects=lambda rows: _reject_rows(rows.withColumns(trimmed), F.col(PROBLEMS), names, row_no, model),
        summary=lambda rows: summary(rows, F.col("_tw_sound"), F.col(OK)),
    )
    return JobResult(clean, rejects, summary(df, sound, sound & fine), routing)


def _tagged(
    df: DataFrame, ok: Column, problems: Column, rejects: Callable[[DataFrame, Column], DataFrame],
    summary: Callable[[DataFrame, Column, Column], DataFrame], errors: Column,
) -> JobResult:
    """Result and routing of a job whose rows pass, or fail with an array of problems.

    ``rejects`` gets (rows, problems), ``summary`` (rows, ok, errors of a row).
    """
    routing = Routing(
        df, {OK: ok, PROBLEMS: F.when(~ok, problems)}, clean=lambda rows: rows,
        rejects=lambda rows: rejects(rows, F.col(PROBLEMS)),
        summary=lambda rows: summary(rows, F.col(OK), F.coalesce(F.size(F.col(PROBLEMS)), F.lit(0))),
    )
    return JobResult(df.filter(ok), rejects(df.filter(~ok), problems), summary(df, ok, errors), routing)


def sanitize_for_import(
    df: DataFrame,
    model: str | TableModel,
    rule: str = "lenient",
    expected_width: int | None = None,
    row_no: str = ROW_NO,
) -> JobResult:
    """Route rows whose numeric fields are not numbers.

    ``lenient``: the table must be as wide as the model, fields are found by
    position, an empty cell passes.  ``strict38``: fields are found by name, cells
    are trimmed, an empty cell is no number, and ``expected_width`` overrides the
    model's width.
    """
    model = get_model(model)
    names = _data_names(df, row_no)
    width = expected_width or model.width
    if rule == "lenient":
        if len(names) != width:
            raise ValueError(f"header has {len(names)} columns, {model.name} has {width}")
        structure = _width_problem(df, width, "COLUMN_COUNT")
        return _route(df, structure, _numeric_checks(df, model, rule, "position", names), names, row_no, model)
    if not model.numeric:
        raise ValueError(f"model {model.name!r} declares no numeric fields")
    structure = _width_problem(df, width, "IRREPARABLE_STRUCTURE")
    if FIELDS not in df.columns and len(names) != width:
        found = F.lit(f"{len(names)} cells under {width} columns")
        structure = [(F.lit(True), _problem("IRREPARABLE_STRUCTURE", found))]
    # The rule allows white space around a number, so raw cells are checked.
    checks = _numeric_checks(df, model, rule, "name", names)
    return _route(df, structure, checks, names, row_no, model, skipped=True, trim=True)


def audit_numeric(
    df: DataFrame, model: str | TableModel, rule: str = "lenient", cap: int | None = None, row_no: str = ROW_NO
) -> JobResult:
    """Report bad numeric cells without writing a clean table.

    ``cap`` limits the report to that many cells in input order; counters always
    cover every row.
    """
    model = get_model(model)
    names = _data_names(df, row_no)
    if len(names) != model.width:
        raise ValueError(f"header has {len(names)} columns, {model.name} has {model.width}")
    result = _route(
        df, _width_problem(df, model.width, "COLUMN_COUNT"),
        _numeric_checks(df, model, rule, "position", names), names, row_no, model,
    )
    first = lambda rows: _first_rows(result.routing.rejects(rows), cap, "ord", "field")
    return replace(result, rejects=_first_rows(result.rejects, cap, "ord", "field"), routing=replace(result.routing, rejects=first))


def field_error_counts(df: DataFrame, model: str | TableModel, rule: str = "scientific", row_no: str = ROW_NO) -> DataFrame:
    """(field, errors) of invalid numeric cells, most first; fields without errors stay out.

    Only cells that a row has are tested, and none of an unreadable row.  One
    count per field in a single pass, turned into rows afterwards.
    """
    model = get_model(model)
    names = _data_names(df, row_no)
    checks = _numeric_checks(df, model, rule, "position", names)
    fields = [field for field in model.numeric if model.position(field) < len(names)]
    readable = ~is_unreadable(df, len(names)) & ~is_undecodable(df)

    def there(field: str) -> Column:
        return readable & (F.col(FIELDS) > model.position(field)) if FIELDS in df.columns else readable

    counts = df.agg(*[F.count_if(bad & there(field)).alias(field) for field, (bad, _) in zip(fields, checks)])
    return (
        counts.unpivot([], fields, "field", "errors")
        .filter("errors > 0").orderBy(F.desc("errors"), "field")
    )


def _error_count(checks: list[tuple[Column, Column]]) -> Column:
    return reduce(lambda a, b: a + b, [F.when(bad, 1).otherwise(0) for bad, _ in checks], F.lit(0))


def _error_summary(rows: DataFrame, ok: Column, errors: Column) -> DataFrame:
    return rows.agg(
        F.count("*").alias("processed"),
        F.count_if(ok).alias("valid"),
        F.coalesce(F.sum(errors), F.lit(0)).alias("errors"),
    )


def audit_schema(df: DataFrame, model: str | TableModel = MOROSOS, row_no: str = ROW_NO) -> JobResult:
    """Width against the header and strict38 numbers by name; a row may raise several errors."""
    model = get_model(model)
    names = _data_names(df, row_no)
    checks = _width_problem(df, len(names), "COLUMN_COUNT") + _numeric_checks(df, model, "strict38", "name", names)
    ok = _ok(checks)
    return _tagged(
        df, ok, _problems(checks), lambda rows, problems: _reject_rows(rows, problems, names, row_no, model),
        _error_summary, _error_count(checks),
    )


def _cell_check(field: str, kind: str, value: Column) -> tuple[Column, Column]:
    """(bad, details) of one cell under its model rule."""
    empty = F.lit(f"{field} is empty")
    wrong = {
        "decimal": f"{field} is no decimal number: ",
        "int32": f"{field} is no 32-bit integer: ",
        "int64": f"{field} is no 64-bit integer: ",
        "date_shape": f"{field} is no ISO date: ",
    }
    if kind == "required":
        return value == "", empty
    if kind == "decimal":
        bad = ~cells.is_float(value)
    elif kind == "int32":
        bad = ~cells.is_int32(value)
    elif kind == "int64":
        bad = ~cells.is_int64(value)
    elif kind == "date_shape":
        return (value != "") & ~cells.is_date_shaped(value), F.concat(F.lit(wrong[kind]), value)
    else:
        return F.lit(False), F.lit("")
    return bad, F.concat(F.lit(wrong[kind]), value)


def validate_model(
    df: DataFrame,
    model: str | TableModel,
    max_show: int | None = None,
    row_no: str = ROW_NO,
) -> JobResult:
    """Check every cell against its model rule.

    The table must have exactly the model's column names.  Errors carry a kind
    (``ColumnCount``, ``ParseError``, ``TypeError``) and both keys.  ``max_show``
    caps the report at the first errors in input order; ``summary`` counts all.
    """
    model = get_model(model)
    names = _data_names(df, row_no)
    if set(names) != set(model.columns):
        missing = sorted(set(model.columns) - set(names))
        extra = sorted(set(names) - set(model.columns))
        raise ValueError(f"header does not match {model.name}: missing {missing}, extra {extra}")
    if not model.kinds:
        raise ValueError(f"model {model.name!r} declares no cell rules")
    width = [
        (bad, problem.withField("kind", F.lit(("ColumnCount", "ParseError", "EncodingError")[place])))
        for place, (bad, problem) in enumerate(_width_problem(df, model.width, "ColumnCount"))
    ]
    typed = []
    for field, kind in model.kinds.items():
        if kind != "optional":
            bad, details = _cell_check(field, kind, _cell(df, field))
            typed.append((bad, _problem("TypeError", details, field, _cell(df, field))))
    sound = _ok(width)
    checks = width + [(sound & bad, problem) for bad, problem in typed]
    ok = _ok(checks)
    return _tagged(
        df, ok, _problems(checks),
        lambda rows, problems: _first_rows(_reject_rows(rows, problems, names, row_no, model), max_show, "ord", "field"),
        lambda rows, fine, errors: rates(_error_summary(rows, fine, errors), "processed", "errors"), _error_count(checks),
    )


def _structure_error(df: DataFrame, row_no: str) -> Column:
    return structure_error(df, len(_data_names(df, row_no)))


def extract_keys(df: DataFrame, model: str | TableModel, limit: int | None = None, row_no: str = ROW_NO) -> JobResult:
    """(record, key, file, ord): key text of the sound records; the others are rejects (file, ord, record, error_type).

    ``limit`` shows the first keys only, in input order; ``summary`` counts all.
    """
    model = get_model(model)
    require_columns(df, row_no, *model.keys)
    tagged = df.select(
        file_of(df).alias("file"), place_of(df, row_no).alias("ord"), F.col(row_no).alias("record"),
        table_key(df, model).alias("key"), _structure_error(df, row_no).alias("error_type"),
    )
    return _keyed(tagged, "key", lambda rows: _first_rows(rows, limit, "ord"))


def _keyed(tagged: DataFrame, key: str, first: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> JobResult:
    """Keys with the place of their record, and the records without one."""
    readable = F.col("error_type").isNull()
    routing = Routing(
        tagged, {OK: readable}, clean=lambda rows: first(rows).select("record", key, "file", "ord"),
        rejects=lambda rows: rows.select("file", "ord", "record", "error_type"),
        summary=lambda rows: rows.agg(F.count("*").alias("processed"), F.count_if(readable).alias("valid")),
    )
    return JobResult(
        routing.clean(tagged.filter(readable)), routing.rejects(tagged.filter(~readable)), routing.summary(tagged), routing)


def extract_resume_key(df: DataFrame, row_no: str = ROW_NO) -> JobResult:
    """(record, resume_key, file, ord); unsound rows and rows whose ids are no 32-bit integers go to rejects."""
    require_columns(df, row_no, *RESUME_COLUMNS)
    wrong = (
        F.when(~cells.is_int32(_cell(df, "IdTransmit")), "IdTransmit is no 32-bit integer")
        .when(~cells.is_int32(_cell(df, "IdCliente")), "IdCliente is no 32-bit integer")
    )
    tagged = df.select(
        file_of(df).alias("file"), place_of(df, row_no).alias("ord"), F.col(row_no).alias("record"), resume_key(df).alias("resume_key"),
        F.coalesce(_structure_error(df, row_no), wrong).alias("error_type"),
    )
    return _keyed(tagged, "resume_key")


def drop_ragged(df: DataFrame, row_no: str = ROW_NO) -> JobResult:
    """Keep records as wide as the header; the others are ``ColumnMismatch`` rejects.

    Keys are filled in when the table is the 14-column debtor model.
    """
    names = _data_names(df, row_no)
    require_columns(df, FIELDS)
    model = MOROSOS if len(names) == MOROSOS.width and names[0] == MOROSOS.columns[0] else None
    checks = [
        (bad, problem.withField("kind", F.lit(("ColumnMismatch", "ParseError", "EncodingError")[place])))
        for place, (bad, problem) in enumerate(_width_problem(df, len(names), "ColumnMismatch"))
    ]
    ok = _ok(checks)

    def summary(rows: DataFrame, fine: Column, errors: Column) -> DataFrame:
        counts = rows.agg(F.count_if(fine).alias("valid"), F.count_if(~fine).alias("invalid"), F.count("*").alias("processed"))
        return rates(counts, "processed", "invalid")

    return _tagged(
        df, ok, _problems(checks), lambda rows, problems: _reject_rows(rows, problems, names, row_no, model), summary, F.lit(0))


def _first_rows(found: DataFrame, limit: int | None, *order: str) -> DataFrame:
    return found if limit is None else found.orderBy(*order).limit(limit)


def find_missing_key(df: DataFrame, key: str, max_report: int | None = None, row_no: str = ROW_NO) -> JobResult:
    """Rows whose key cell is empty once trimmed; ``max_report`` keeps the first of them, ``summary`` counts all."""
    require_columns(df, key, row_no)
    missing = trim_ws(_cell(df, key)) == ""
    found = df.filter(missing)
    first = found if max_report is None else found.orderBy(place_of(df, row_no)).limit(max_report)
    summary = df.agg(F.count("*").alias("processed"), F.count_if(missing).alias("missing"))
    return JobResult(df.filter(~missing), first, summary)


def _capped(found: DataFrame, limit: int | None, *order: str) -> DataFrame:
    """All rows; with a limit the first ones, beside the number of all in ``total``."""
    if limit is None:
        return found
    return _first_rows(found, limit, *order).withColumn("total", found.select(F.count("*")).scalar())


def find_oversize(lines: DataFrame, threshold: int = 350_000, max_report: int | None = None) -> DataFrame:
    """(file, line_no, bytes) of lines longer than ``threshold`` UTF-8 bytes; with ``max_report`` the first ones and ``total``."""
    size = F.octet_length("line")
    found = lines.filter(size > threshold).select("ord", "file", "line_no", size.alias("bytes"))
    return _capped(found, max_report, "ord").drop("ord")


def find_invalid_numeric(
    df: DataFrame, columns: list[str], rule: str = "strict38", max_report: int | None = None, row_no: str = ROW_NO
) -> DataFrame:
    """(file, line, field, value) of cells that fail the number rule; with ``max_report`` the first ones and ``total``."""
    require_columns(df, row_no, *columns)
    valid = cells.number_rule(rule)
    checks = [
        (~valid(_cell(df, name)), F.struct(F.lit(name).alias("field"), _cell(df, name).alias("value")))
        for name in columns
    ]
    found = F.filter(F.array(*[F.when(bad, pair) for bad, pair in checks]), lambda pair: pair.isNotNull())
    rows = df.filter(~_ok(checks)).select(
        place_of(df, row_no).alias("ord"), file_of(df).alias("file"), (F.col(row_no) + 1).alias("line"), F.inline(found)
    )
    return _capped(rows, max_report, "ord", "field").drop("ord")


def check_numeric_keys(df: DataFrame, model: str | TableModel, row_no: str = ROW_NO) -> JobResult:
    """Key cells must be digits once trimmed: ``EMPTY_KEY`` or ``NON_DIGIT_KEY`` rejects."""
    model = get_model(model)
    require_columns(df, row_no, *model.keys)
    checks = []
    for key in model.keys:
        value = trim_ws(_cell(df, key))
        checks.append((value == "", _problem("EMPTY_KEY", F.lit(f"{key} is empty"), key, value)))
        bad = (value != "") & ~value.rlike(cells.DIGITS_PATTERN)
        checks.append((bad, _problem("NON_DIGIT_KEY", F.concat(F.lit(f"{key} is not digits only: "), value), key, value)))
    ok = _ok(checks)
    names = _data_names(df, row_no)
    return _tagged(
        df, ok, _problems(checks), lambda rows, problems: _reject_rows(rows, problems, names, row_no, model),
        lambda rows, fine, errors: rows.agg(F.count("*").alias("processed"), F.count_if(fine).alias("valid")), F.lit(0))
