"""Registered queries: every operator run over whole tables, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.csvtext import render_line
from tabwright.operators import dates as date_jobs
from tabwright.operators import headers, merge, profiles, quality, slices
from tabwright.plans import fixtures as fx
from tabwright.plans.models import MOROSOS, TableModel
from tabwright.plans.results import FIELDS, ROW_NO, sound_rows, unsound_rows
from tabwright.plans.scale import new_folder
from tabwright.sources import kept
from tabwright.sources import lines as line_source
from tabwright.sources.records import parse_lines
from tabwright.sources import normalize_header, read_records, write_chunks, write_lines, write_records, write_rejects

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return run

    return register


# ---------------------------------------------------------------- filters and slices

@query("q_filter_equals", """
SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice FROM lineitem WHERE coalesce(l_returnflag, '') = 'R'
""")
def _(spark, sf):
    kept = slices.filter_equals(fx.table(spark, sf, "lineitem"), "l_returnflag", "R")
    return kept.select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")


@query("q_drop_repeated_header", f"""
WITH {fx.DOC_LINES}
SELECT CAST(a.doc_id AS VARCHAR) AS file, a.line_no, a.line
FROM doc_lines a JOIN doc_lines h ON h.doc_id = a.doc_id AND h.line_no = 1
WHERE a.line_no = 1 OR a.line <> h.line
""")
def _(spark, sf):
    return slices.drop_repeated_header(fx.document_lines(spark, sf)).select("file", "line_no", "line")


@query("q_has_repeated_header", f"""
WITH {fx.DOC_LINES}
SELECT CAST(a.doc_id AS VARCHAR) AS file, count(*) AS repeats
FROM doc_lines a JOIN doc_lines h ON h.doc_id = a.doc_id AND h.line_no = 1
WHERE a.line_no > 1 AND rtrim(a.line) = rtrim(h.line) GROUP BY 1
""")
def _(spark, sf):
    return profiles.has_repeated_header(fx.document_lines(spark, sf))


_BLANKED = f"""
WITH {fx.DOC_LINES},
blanked AS (
  SELECT doc_id, line_no, CASE line_no % 5 WHEN 1 THEN '  ' WHEN 2 THEN ',,,' WHEN 3 THEN ' , , ' ELSE line END AS line
  FROM doc_lines)
"""


def _blanked(spark, sf):
    turn = F.col("line_no") % 5
    line = F.when(turn == 1, "  ").when(turn == 2, ",,,").when(turn == 3, " , , ").otherwise(F.col("line"))
    return fx.document_lines(spark, sf).withColumn("line", line)


@query("q_drop_blank", f"""{_BLANKED}
SELECT CAST(doc_id AS VARCHAR) AS file, line_no, line FROM blanked
WHERE length(regexp_replace(trim(line), '^,+|,+$', '', 'g')) > 0
""")
def _(spark, sf):
    return slices.drop_blank_lines(_blanked(spark, sf)).select("file", "line_no", "line")


@query("q_sanitize_text", f"""{_BLANKED}
SELECT count(*) AS total_lines, count(*) FILTER (WHERE bare = '') AS blank_removed,
  count(*) FILTER (WHERE bare <> '') AS final_lines, count(*) FILTER (WHERE bare <> '') - 1 AS data_rows
FROM (SELECT regexp_replace(trim(line), '^,+|,+$', '', 'g') AS bare FROM blanked)
""")
def _(spark, sf):
    return slices.sanitize_text(_blanked(spark, sf)).summary


@query("q_delete_from_row", """
SELECT event_id, user_id, trim(event_type) AS event_type, trim(props) AS props FROM events WHERE event_id + 2 < 5001
""")
def _(spark, sf):
    events = fx.table(spark, sf, "events").withColumn(ROW_NO, F.col("event_id") + 1)
    return slices.delete_from_row(events, 5001).select("event_id", "user_id", "event_type", "props")


@query("q_head", f"""
WITH {fx.DOC_LINES} SELECT CAST(doc_id AS VARCHAR) AS file, line_no, line FROM doc_lines WHERE line_no <= 4
""")
def _(spark, sf):
    return slices.head(fx.document_lines(spark, sf), 3).select("file", "line_no", "line")


@query("q_tail", f"""
WITH {fx.DOC_LINES},
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no DESC) AS from_end FROM doc_lines)
SELECT CAST(doc_id AS VARCHAR) AS file, line_no, line FROM ranked WHERE line_no = 1 OR from_end <= 3
""")
def _(spark, sf):
    return slices.tail(fx.document_lines(spark, sf), 3).select("file", "line_no", "line")


@query("q_inspect_line", f"""
WITH {fx.DOC_LINES}
SELECT CAST(doc_id AS VARCHAR) AS file, line_no, line, line_no = 3 AS is_target FROM doc_lines WHERE line_no BETWEEN 2 AND 4
""")
def _(spark, sf):
    return slices.inspect_line(fx.document_lines(spark, sf), 3, 1).select("file", "line_no", "line", "is_target")


@query("q_split_chunks", """
SELECT event_id // 500 + 1 AS chunk_id, count(*) AS records, min(event_id) AS first_id, max(event_id) AS last_id
FROM events GROUP BY 1
""")
def _(spark, sf):
    events = fx.table(spark, sf, "events").withColumn(ROW_NO, F.col("event_id") + 1)
    return slices.split_chunks(events, 500).groupBy(F.col("_chunk_id").alias("chunk_id")).agg(
        F.count("*").alias("records"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")
    )


# ---------------------------------------------------------------- merge and dedup

_MERGED = f"""
WITH {fx.DOC_LINES},
merged AS (
  SELECT doc_id, line_no, line, line_no = 1 AS is_header FROM doc_lines
  WHERE line_no > 1 OR {fx.ORD} = (SELECT min({fx.ORD}) FROM doc_lines))
"""


@query("q_merge", f"{_MERGED} SELECT CAST(doc_id AS VARCHAR) AS file, line_no, line FROM merged")
def _(spark, sf):
    return merge.merge(fx.document_lines(spark, sf)).select("file", "line_no", "line")


@query("q_merge_dedup", f"{_MERGED} SELECT line, is_header, min({fx.ORD}) AS ord FROM merged GROUP BY 1, 2")
def _(spark, sf):
    return merge.merge_dedup(fx.document_lines(spark, sf))


@query("q_merge_dedup_sorted", f"""{_MERGED}
SELECT line, is_header, row_number() OVER (ORDER BY is_header DESC, line) AS place
FROM (SELECT DISTINCT line, is_header FROM merged)
""")
def _(spark, sf):
    return merge.merge_dedup_sorted(fx.document_lines(spark, sf), numbered=True)


@query("q_merge_mixed", f"""
WITH {fx.DOC_LINES},
mixed AS (
  SELECT doc_id, line_no, CASE WHEN line_no = 1 AND doc_id % 2 = 0 THEN ' Name,Age ' ELSE line END AS line FROM doc_lines)
SELECT 'Name,Age' AS line, true AS is_header, CAST(-1 AS BIGINT) AS ord
UNION ALL
SELECT line, false, min({fx.ORD}) FROM mixed WHERE NOT (line_no = 1 AND trim(line) = 'Name,Age') GROUP BY line
""")
def _(spark, sf):
    lines = fx.document_lines(spark, sf)
    headed = F.when((F.col("line_no") == 1) & (F.col("file_ord") % 2 == 0), " Name,Age ").otherwise(F.col("line"))
    return merge.merge_dedup_mixed(lines.withColumn("line", headed), "Name,Age")


@query("q_merge_records_dedup", """
SELECT text, lang AS tag FROM documents UNION SELECT text, role FROM conversations
""")
def _(spark, sf):
    documents = fx.table(spark, sf, "documents").select("text", F.col("lang").alias("tag"))
    return merge.merge_records_dedup([documents, fx.table(spark, sf, "conversations").select("text", "role")])


@query("q_dedup_records", "SELECT text, lang, min(doc_id) AS doc_id FROM documents GROUP BY text, lang")
def _(spark, sf):
    return merge.dedup_records(fx.table(spark, sf, "documents").select("text", "lang", "doc_id"), "doc_id")


@query("q_dedup_last", """
SELECT event_id, user_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1
""")
def _(spark, sf):
    events = fx.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "props")
    return merge.dedup_by_key(events, ["user_id", "event_type"], "event_id").clean


@query("q_dedup_key_strict", f"""
WITH {fx.DEBTORS} SELECT Cuil, IdCliente, max(k) + 1 AS row_no FROM debtors GROUP BY 1, 2
""")
def _(spark, sf):
    found = merge.dedup_by_key(fx.debtors(spark, sf), ["Cuil", "IdCliente"], ROW_NO, strict=True)
    return found.clean.select("Cuil", "IdCliente", F.col(ROW_NO).alias("row_no"))


def _dedup_ragged(spark, sf):
    return merge.dedup_by_key(fx.ragged_debtors(spark, sf), ["Cuil", "IdCliente"], ROW_NO)


_DEDUP_REASON = f"""
WITH {fx.DEBTOR_LINES},
reasons AS (
  SELECT *, CASE WHEN n_fields <> 14 THEN 'LENGTH_MISMATCH' WHEN Cuil = '' OR IdCliente = '' THEN 'EMPTY_KEY' END AS reason
  FROM debtor_lines)
"""


@query("q_dedup_key_rejects", f"""{_DEDUP_REASON}
SELECT k + 1 AS line, reason AS error_type FROM reasons WHERE reason IS NOT NULL
""")
def _(spark, sf):
    return _dedup_ragged(spark, sf).rejects.select("line", "error_type")


@query("q_dedup_key_summary", f"""{_DEDUP_REASON}
SELECT count(*) AS processed, count(DISTINCT (Cuil, IdCliente)) FILTER (WHERE reason IS NULL) AS "unique",
  count(reason) AS errors,
  count(*) - count(DISTINCT (Cuil, IdCliente)) FILTER (WHERE reason IS NULL) - count(reason) AS duplicates
FROM reasons
""")
def _(spark, sf):
    return _dedup_ragged(spark, sf).summary


@query("q_compare", """
WITH changed AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN o_orderstatus || '*' ELSE o_orderstatus END AS o_orderstatus FROM orders)
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, coalesce(a.o_orderstatus, '') AS left_value, coalesce(b.o_orderstatus, '') AS right_value
FROM orders a FULL JOIN changed b ON a.o_orderkey = b.o_orderkey
WHERE coalesce(a.o_orderstatus, '') <> coalesce(b.o_orderstatus, '')
""")
def _(spark, sf):
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    changed = F.when(F.col("o_orderkey") % 10 == 0, F.concat("o_orderstatus", F.lit("*"))).otherwise(F.col("o_orderstatus"))
    return merge.compare(orders, orders.withColumn("o_orderstatus", changed), "o_orderkey", "o_orderstatus")


def _event_lines(spark, sf):
    events = fx.table(spark, sf, "events").select(
        F.lit("events").alias("file"), F.lit(0).alias("file_ord"), (F.col("event_id") + 1).alias("line_no"),
        F.concat_ws(",", F.col("user_id").cast("string"), "event_type", "props").alias("line"),
    )
    return line_source.line_table(events, "file", "file_ord", "line_no", "line")


@query("q_compare_first_n", """
WITH one AS (
  SELECT event_id + 1 AS line_no, concat_ws(',', CAST(user_id AS VARCHAR), event_type, props) AS line FROM events WHERE event_id <= 5000),
two AS (SELECT line_no, CASE WHEN line_no % 7 = 4 THEN line || '!' ELSE line END AS line FROM one),
pairs AS (
  SELECT coalesce(one.line_no, two.line_no) AS line_no, coalesce(one.line, '') <> coalesce(two.line, '') AS differs
  FROM one FULL JOIN two ON one.line_no = two.line_no)
SELECT count(*) FILTER (WHERE line_no = 1 AND differs) = 0 AS headers_equal,
  count(*) FILTER (WHERE line_no > 1 AND differs) AS differences FROM pairs
""")
def _(spark, sf):
    left = _event_lines(spark, sf)
    changed = F.when(F.col("line_no") % 7 == 4, F.concat("line", F.lit("!"))).otherwise(F.col("line"))
    return merge.compare_first_n(left, left.withColumn("line", changed), 5000).summary


# ---------------------------------------------------------------- counts

@query("q_count_lines", f"""
WITH {fx.DOC_LINES} SELECT count(*) AS lines, count(*) FILTER (WHERE line_no > 1) AS data_rows FROM doc_lines
""")
def _(spark, sf):
    return profiles.count_lines(fx.document_lines(spark, sf))


@query("q_count_by_file", """
SELECT CASE WHEN grouping(source) = 1 THEN 'TOTAL' ELSE source END AS file, count(*) AS lines
FROM documents GROUP BY ROLLUP (source)
""")
def _(spark, sf):
    return profiles.count_by_file(fx.table(spark, sf, "documents"), "source")


@query("q_count_unique_lines", f"""
WITH {fx.DOC_LINES} SELECT count(DISTINCT line) AS unique_lines FROM doc_lines WHERE line_no > 1
""")
def _(spark, sf):
    return profiles.count_unique(fx.document_lines(spark, sf))


@query("q_unique_by_first_file", f"""{_MERGED},
firsts AS (SELECT min({fx.ORD}) AS ord FROM merged GROUP BY line),
newly AS (SELECT ord // 1099511627776 AS doc_id, count(*) AS unique_lines FROM firsts GROUP BY 1),
totals AS (SELECT doc_id, count(*) AS lines FROM doc_lines GROUP BY 1),
per_file AS (
  SELECT CAST(t.doc_id AS VARCHAR) AS file, t.lines, coalesce(n.unique_lines, 0) AS unique_lines
  FROM totals t LEFT JOIN newly n USING (doc_id))
SELECT CASE WHEN grouping(file) = 1 THEN 'TOTAL' ELSE file END AS file, CAST(sum(lines) AS BIGINT) AS lines,
  CAST(sum(unique_lines) AS BIGINT) AS unique_lines, CAST(sum(lines) - sum(unique_lines) AS BIGINT) AS duplicates
FROM per_file GROUP BY ROLLUP (file)
""")
def _(spark, sf):
    return profiles.count_unique(fx.document_lines(spark, sf), header="first")


# ---------------------------------------------------------------- headers

_FLOAT = r"[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))"
_EXPECTED = "['" + "', '".join(MOROSOS.columns) + "']"


@query("q_header_check", f"""
WITH {fx.HEADER_FILES},
file_lines AS (SELECT file, header AS line, true AS top FROM header_files UNION ALL SELECT file, data, false FROM header_files),
names AS (
  SELECT file, string_split(max(line) FILTER (WHERE top), ',') AS cells, count(*) FILTER (WHERE NOT top) AS records FROM file_lines GROUP BY file),
found AS (
  SELECT file, cells, records,
    list_sort(list_distinct(list_filter(cells, lambda x: len(list_filter(cells, lambda y: y = x)) > 1))) AS twice,
    list_filter({_EXPECTED}, lambda x: NOT list_contains(cells, x)) AS missing,
    list_distinct(list_filter(cells, lambda x: NOT list_contains({_EXPECTED}, x))) AS extra
  FROM names)
SELECT file, CAST(len(cells) AS INTEGER) AS n_columns, records, array_to_string(twice, ',') AS duplicates,
  array_to_string(list_sort(missing), ',') AS missing, array_to_string(list_sort(extra), ',') AS extra,
  CASE WHEN len(twice) > 0 THEN 'duplicate' WHEN len(missing) + len(extra) > 0 THEN 'mismatch' ELSE 'ok' END AS status
FROM found
""")
def _(spark, sf):
    return headers.check_header(fx.header_files(spark, sf), MOROSOS)


# A header that holds an empty cell or a number is data.
_LACKING = f"""
looks AS (
  SELECT *, len(list_filter(string_split(header, ','), lambda x: trim(x) = '' OR regexp_full_match(trim(x), '{_FLOAT}'))) > 0 AS is_data
  FROM header_files),
flagged AS (SELECT *, is_data AND trim(header) <> '{MOROSOS.header}' AS lacks FROM looks)
"""


@query("q_detect_header", f"""
WITH {fx.HEADER_FILES}, {_LACKING} SELECT file, is_data AS missing_header FROM flagged
""")
def _(spark, sf):
    return headers.detect_missing_header(fx.header_files(spark, sf))


@query("q_detect_expected_header", f"""
WITH {fx.HEADER_FILES} SELECT file, trim(header) <> '{MOROSOS.header}' AS missing_header FROM header_files
""")
def _(spark, sf):
    return headers.detect_missing_header(fx.header_files(spark, sf), MOROSOS.header)


@query("q_add_header", f"""
WITH {fx.HEADER_FILES}, {_LACKING}
SELECT file, CAST(1 AS BIGINT) AS line_no, '{MOROSOS.header}' AS line, true AS header_added FROM flagged WHERE lacks
UNION ALL SELECT file, CASE WHEN lacks THEN 2 ELSE 1 END, header, lacks FROM flagged
UNION ALL SELECT file, CASE WHEN lacks THEN 3 ELSE 2 END, data, lacks FROM flagged
""")
def _(spark, sf):
    return headers.add_header(fx.header_files(spark, sf), MOROSOS).select("file", "line_no", "line", "header_added")


# ---------------------------------------------------------------- validation

_PLAIN = r"-?(0|[1-9][0-9]*)(\.[0-9]+)?"
_SCIENTIFIC = r"-?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"


def _lenient(name: str) -> str:
    return f"({name} = '' OR regexp_full_match({name}, '{_FLOAT}'))"


def _strict(name: str) -> str:
    return f"(regexp_full_match({name}, '{_PLAIN}') AND length(translate({name}, '.-', '')) <= 38)"


def _scientific(name: str) -> str:
    return f"regexp_full_match({name}, '{_SCIENTIFIC}')"


def _all(rule) -> str:
    return " AND ".join(rule(name) for name in MOROSOS.numeric)


def _bad_cells(rule, source: str = "debtors", where: str = "true") -> str:
    return " UNION ALL ".join(
        f"SELECT k + 2 AS line, '{name}' AS field, {name} AS value FROM {source} WHERE {where} AND NOT {rule(name)}"
        for name in MOROSOS.numeric
    )


_CELLS = ", ".join(MOROSOS.columns)


@query("q_sanitize_lenient", f"WITH {fx.DEBTORS} SELECT {_CELLS} FROM debtors WHERE {_all(_lenient)}")
def _(spark, sf):
    return quality.sanitize_for_import(fx.debtors(spark, sf), MOROSOS).clean.select(*MOROSOS.columns)


_KEY = "'{Cuil=' || Cuil || ',IdTransmit=' || IdTransmit || '}'"
_I32 = "(regexp_full_match({0}, '[+-]?[0-9]+') AND TRY_CAST({0} AS BIGINT) BETWEEN -2147483648 AND 2147483647)"
_RESUME = f"""CASE WHEN {_I32.format('IdCliente')} AND {_I32.format('IdTransmit')}
  THEN '{{IdCliente=' || CAST(TRY_CAST(IdCliente AS BIGINT) AS VARCHAR) || ',IdTransmit='
    || CAST(TRY_CAST(IdTransmit AS BIGINT) AS VARCHAR) || ',NroDoc=' || NroDoc || '}}' END"""
_LINE = " || ',' || ".join(MOROSOS.columns)


@query("q_sanitize_lenient_rejects", f"""
WITH {fx.DEBTORS}, bad AS ({_bad_cells(_lenient)})
SELECT bad.line, bad.field, bad.value, 'INVALID_NUMERIC' AS error_type, {_KEY} AS table_key, {_LINE} AS record
FROM bad JOIN debtors ON bad.line = debtors.k + 2
""")
def _(spark, sf):
    rejects = quality.sanitize_for_import(fx.debtors(spark, sf), MOROSOS).rejects
    return rejects.select("line", "field", "value", "error_type", "table_key", "record")


def _non_numeric(name: str) -> str:
    return f"CASE WHEN regexp_full_match({name}, '{_FLOAT}') THEN {name} ELSE '\"' || replace({name}, '\"', '\"\"') || '\"' END"


@query("q_sanitize_strict", f"""
WITH {fx.DEBTORS} SELECT k + 1 AS row_no, {" || ',' || ".join(_non_numeric(name) for name in MOROSOS.columns)} AS line
FROM debtors WHERE {_all(_strict)}
""")
def _(spark, sf):
    clean = quality.sanitize_for_import(fx.debtors(spark, sf), MOROSOS, rule="strict38").clean
    return clean.select(
        F.col(ROW_NO).alias("row_no"), render_line(list(MOROSOS.columns), quote="non_numeric").alias("line")
    )


@query("q_sanitize_strict_rejects", f"""
WITH {fx.DEBTOR_LINES}
SELECT line, field, value, 'INVALID_NUMERIC' AS error_type FROM ({_bad_cells(_strict, 'debtor_lines', 'n_fields = 14')})
UNION ALL SELECT k + 2, NULL, NULL, 'SKIPPED' FROM debtor_lines WHERE n_fields = 14 AND NOT ({_all(_strict)})
UNION ALL SELECT k + 2, NULL, NULL, 'IRREPARABLE_STRUCTURE' FROM debtor_lines WHERE n_fields <> 14
""")
def _(spark, sf):
    found = quality.sanitize_for_import(fx.ragged_debtors(spark, sf), MOROSOS, rule="strict38")
    return found.rejects.select("line", "field", "value", "error_type")


@query("q_run_summary", f"""
WITH {fx.DEBTOR_LINES},
tagged AS (SELECT n_fields = 14 AS sound, ({_all(_strict)}) AS fine FROM debtor_lines),
counts AS (
  SELECT count(*) AS processed, count(*) FILTER (WHERE sound AND fine) AS valid,
    count(*) FILTER (WHERE sound AND NOT fine) AS invalid_numeric, count(*) FILTER (WHERE NOT sound) AS irreparable FROM tagged)
SELECT *, round(valid * 100.0 / processed, 2)::DOUBLE AS valid_percent,
  round(invalid_numeric * 100.0 / processed, 2)::DOUBLE AS invalid_numeric_percent,
  round(irreparable * 100.0 / processed, 2)::DOUBLE AS irreparable_percent
FROM counts
""")
def _(spark, sf):
    return quality.sanitize_for_import(fx.ragged_debtors(spark, sf), MOROSOS, rule="strict38").summary


@query("q_audit_numeric", f"""
WITH {fx.DEBTORS}, bad AS ({_bad_cells(_lenient)}) SELECT line, field, value FROM bad
""")
def _(spark, sf):
    return quality.audit_numeric(fx.debtors(spark, sf), MOROSOS).rejects.select("line", "field", "value")


@query("q_audit_scientific", f"""
WITH {fx.DEBTORS}, bad AS ({_bad_cells(_scientific)}) SELECT line, field, value FROM bad
""")
def _(spark, sf):
    found = quality.audit_numeric(fx.debtors(spark, sf), MOROSOS, rule="scientific")
    return found.rejects.select("line", "field", "value")


@query("q_field_errors", f"""
WITH {fx.DEBTORS}, bad AS ({_bad_cells(_strict)}) SELECT field, count(*) AS errors FROM bad GROUP BY field
""")
def _(spark, sf):
    return quality.field_error_counts(fx.debtors(spark, sf), MOROSOS, rule="strict38")


@query("q_audit_schema", f"""
WITH {fx.DEBTOR_LINES}
SELECT line, field, value, 'INVALID_NUMERIC' AS error_type FROM ({_bad_cells(_strict, 'debtor_lines')})
UNION ALL SELECT k + 2, NULL, NULL, 'COLUMN_COUNT' FROM debtor_lines WHERE n_fields <> 14
""")
def _(spark, sf):
    return quality.audit_schema(fx.ragged_debtors(spark, sf)).rejects.select("line", "field", "value", "error_type")


def _type_errors() -> str:
    checks = []
    for field, kind in MOROSOS.kinds.items():
        if kind == "decimal":
            checks.append((field, f"NOT regexp_full_match({field}, '{_FLOAT}')", f"'{field} is no decimal number: ' || {field}"))
        elif kind == "int32":
            checks.append((field, f"NOT {_I32.format(field)}", f"'{field} is no 32-bit integer: ' || {field}"))
        elif kind == "required":
            checks.append((field, f"{field} = ''", f"'{field} is empty'"))
    return " UNION ALL ".join(
        f"SELECT k + 2 AS line, 'TypeError' AS error_type, '{field}' AS field, {details} AS details, "
        f"{_KEY} AS table_key, coalesce({_RESUME}, 'INVALID_SQL_KEY') AS resume_key FROM debtors WHERE coalesce({bad}, true)"
        for field, bad, details in checks
    )


@query("q_validate_model", f"WITH {fx.DEBTORS} {_type_errors()}")
def _(spark, sf):
    found = quality.validate_model(fx.debtors(spark, sf), MOROSOS).rejects
    return found.select("line", "error_type", "field", "details", "table_key", "resume_key")


@query("q_validate_summary", f"""
WITH {fx.DEBTORS}, bad AS ({_type_errors()}),
counts AS (
  SELECT (SELECT count(*) FROM debtors) AS processed,
    (SELECT count(*) FROM debtors) - (SELECT count(DISTINCT line) FROM bad) AS valid, (SELECT count(*) FROM bad) AS errors)
SELECT *, round(errors * 100.0 / processed, 2)::DOUBLE AS errors_percent FROM counts
""")
def _(spark, sf):
    return quality.validate_model(fx.debtors(spark, sf), MOROSOS).summary


@query("q_reject_log", f"""
WITH {fx.DEBTORS}, bad AS ({_type_errors()})
SELECT CAST(line AS VARCHAR) AS "Line", error_type AS "ErrorType", details AS "Details",
  table_key AS "DynamoDbKey", resume_key AS "SqlCompositeKey" FROM bad
""")
def _(spark, sf):
    folder = new_folder(spark)
    write_rejects(quality.validate_model(fx.debtors(spark, sf), MOROSOS).rejects, folder)
    return spark.read.option("header", True).option("escape", '"').option("emptyValue", "").csv(folder)


@query("q_keys", f"WITH {fx.DEBTORS} SELECT k + 1 AS record, {_KEY} AS key, CAST(NULL AS VARCHAR) AS file, k + 1 AS ord FROM debtors")
def _(spark, sf):
    return quality.extract_keys(fx.debtors(spark, sf), MOROSOS).clean


@query("q_resume_key", f"""
WITH {fx.DEBTORS}, keyed AS (SELECT k + 1 AS record, {_RESUME} AS resume_key FROM debtors)
SELECT * FROM keyed WHERE resume_key IS NOT NULL
""")
def _(spark, sf):
    return quality.extract_resume_key(fx.debtors(spark, sf)).clean.select("record", "resume_key")


@query("q_drop_ragged", f"""
WITH {fx.DEBTOR_LINES} SELECT k + 1 AS row_no, Cuil, IdTransmit,
  CASE WHEN k % 139 = 8 THEN 'A, B' ELSE RazonSocial END AS RazonSocial, CreateUser
FROM debtor_lines WHERE n_fields = 14
""")
def _(spark, sf):
    clean = quality.drop_ragged(fx.ragged_debtors(spark, sf)).clean
    return clean.select(F.col(ROW_NO).alias("row_no"), "Cuil", "IdTransmit", "RazonSocial", "CreateUser")


@query("q_drop_ragged_rejects", f"""
WITH {fx.DEBTOR_LINES}
SELECT k + 2 AS line, 'ColumnMismatch' AS error_type, CAST(n_fields AS VARCHAR) || ' cells under 14 columns' AS details,
  {_KEY} AS table_key, line AS record
FROM debtor_lines WHERE n_fields <> 14
""")
def _(spark, sf):
    rejects = quality.drop_ragged(fx.ragged_debtors(spark, sf)).rejects
    return rejects.select("line", "error_type", "details", "table_key", "record")


@query("q_missing_key", f"WITH {fx.DEBTORS} SELECT k + 1 AS row_no, Cuil, IdTransmit FROM debtors WHERE trim(Cuil) = ''")
def _(spark, sf):
    found = quality.find_missing_key(fx.debtors(spark, sf), "Cuil")
    return found.rejects.select(F.col(ROW_NO).alias("row_no"), "Cuil", "IdTransmit")


@query("q_oversize", """
SELECT CAST(doc_id AS VARCHAR) AS file, CAST(1 AS BIGINT) AS line_no, CAST(octet_length(encode(text)) AS INTEGER) AS bytes
FROM documents WHERE octet_length(encode(text)) > 5000
""")
def _(spark, sf):
    documents = fx.table(spark, sf, "documents").withColumn("line_no", F.lit(1))
    lines = line_source.line_table(documents, "doc_id", "doc_id", "line_no", "text")
    return quality.find_oversize(lines, threshold=5000)


@query("q_invalid_numeric", f"""
WITH {fx.DEBTORS}, bad AS ({_bad_cells(_strict)}) SELECT line, field, value FROM bad WHERE field IN ('Cuil', 'IdRegion', 'IdEntidad')
""")
def _(spark, sf):
    return quality.find_invalid_numeric(fx.debtors(spark, sf), ["Cuil", "IdRegion", "IdEntidad"]).drop("file")


@query("q_check_numeric_keys", f"""
WITH {fx.DEBTORS}
SELECT k + 2 AS line, 'Cuil' AS field, Cuil AS value, CASE WHEN Cuil = '' THEN 'EMPTY_KEY' ELSE 'NON_DIGIT_KEY' END AS error_type
FROM debtors WHERE NOT regexp_full_match(Cuil, '[0-9]+')
UNION ALL
SELECT k + 2, 'IdTransmit', IdTransmit, CASE WHEN IdTransmit = '' THEN 'EMPTY_KEY' ELSE 'NON_DIGIT_KEY' END
FROM debtors WHERE NOT regexp_full_match(IdTransmit, '[0-9]+')
""")
def _(spark, sf):
    rejects = quality.check_numeric_keys(fx.debtors(spark, sf), MOROSOS).rejects
    return rejects.select("line", "field", "value", "error_type")


# ---------------------------------------------------------------- dates

@query("q_convert_date", f"""
WITH {fx.DATES} SELECT k + 1 AS row_no, coalesce(iso, '') AS raw FROM parsed WHERE raw = '' OR iso IS NOT NULL
""")
def _(spark, sf):
    clean = date_jobs.convert_date(fx.dates(spark, sf), "raw").clean
    return clean.select(F.col(ROW_NO).alias("row_no"), "raw")


@query("q_convert_date_rejects", f"""
WITH {fx.DATES} SELECT k + 2 AS line, 'DATE_CONVERSION_ERROR' AS error_type, raw AS original,
  id || ',' || raw || ',' || us12 || ',' || cell || ',' || priority AS record
FROM parsed WHERE raw <> '' AND iso IS NULL
""")
def _(spark, sf):
    return date_jobs.convert_date(fx.dates(spark, sf), "raw").rejects.drop("file")


@query("q_convert_all_dates", f"""
WITH {fx.DATES} SELECT k + 1 AS row_no, us12,
  CASE WHEN cell <> 'hello' THEN strftime(ts, '%Y-%m-%d') ELSE cell END AS cell,
  CAST(CASE WHEN cell <> 'hello' THEN 1 ELSE 0 END AS INTEGER) AS converted
FROM dates
""")
def _(spark, sf):
    found = date_jobs.convert_all_dates(fx.dates(spark, sf))
    return found.select(F.col(ROW_NO).alias("row_no"), "us12", "cell", F.col("_converted").alias("converted"))


_PREVIEW = "id || ' | ' || raw || ' | ' || us12 || ' | ' || cell || ' | ' || priority"


def _extreme(pick: str, tie: str) -> str:
    return f"""
WITH {fx.DATES}
SELECT strftime({pick}(us_ts, (us_ts, {tie})), '%Y-%m-%dT%H:%M:%S') AS date, {pick}(k, (us_ts, {tie})) + 2 AS line,
  {pick}({_PREVIEW}, (us_ts, {tie})) AS preview, (SELECT count(*) FROM parsed) AS processed, count(*) AS valid,
  (SELECT count(*) FROM parsed) - count(*) AS invalid, CAST(0 AS BIGINT) AS short_rows
FROM parsed WHERE us_ts IS NOT NULL
"""


@query("q_oldest", _extreme("arg_min", "k"))
def _(spark, sf):
    return date_jobs.find_oldest(fx.dates(spark, sf), "us12").drop("file", "ord")


@query("q_newest", _extreme("arg_max", "-k"))
def _(spark, sf):
    return date_jobs.find_newest(fx.dates(spark, sf), "us12").drop("file", "ord")


def _orders_by_priority(spark, sf):
    """Each order priority is a file; dates are ISO text."""
    return fx.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("_file"), F.col("o_orderdate").cast("string").alias("day")
    )


@query("q_find_latest", """
SELECT strftime(max(o_orderdate), '%Y-%m-%dT%H:%M:%S') AS latest, count(*) AS valid, CAST(0 AS BIGINT) AS invalid FROM orders
""")
def _(spark, sf):
    return date_jobs.find_latest(_orders_by_priority(spark, sf), "day", fmt="iso")


def _by_priority(pick: str, name: str) -> str:
    return f"""
SELECT CASE WHEN grouping(o_orderpriority) = 1 THEN 'TOTAL' ELSE o_orderpriority END AS file,
  strftime({pick}(o_orderdate), '%Y-%m-%dT%H:%M:%S') AS {name}, count(*) AS valid
FROM orders GROUP BY ROLLUP (o_orderpriority)
"""


@query("q_latest_batch", _by_priority("max", "latest"))
def _(spark, sf):
    return date_jobs.find_latest_batch(_orders_by_priority(spark, sf), "day", fmt="iso")


@query("q_earliest_batch", _by_priority("min", "earliest"))
def _(spark, sf):
    return date_jobs.find_earliest_batch(_orders_by_priority(spark, sf), "day", fmt="iso")


def _by_month(year: int, month: int, last: str) -> str:
    return f"""
WITH {fx.DATES},
seen AS (
  SELECT *, year(us_ts) = {year} AND month(us_ts) = {month} AS inside, abs(epoch(us_ts) - epoch(TIMESTAMP '{last}')) AS away
  FROM parsed WHERE us_ts IS NOT NULL),
counts AS (SELECT count(*) FILTER (WHERE inside) AS matched, count(*) AS valid FROM seen),
best AS (
  SELECT * FROM seen, counts
  ORDER BY CASE WHEN matched > 0 AND NOT inside THEN 1 ELSE 0 END, CASE WHEN matched > 0 THEN -epoch(us_ts) ELSE away END, k LIMIT 1)
SELECT matched > 0 AS found, matched, valid, strftime(us_ts, '%Y-%m-%dT%H:%M:%S') AS date, k + 2 AS line, {_PREVIEW} AS preview,
  CASE WHEN matched = 0 THEN CAST(floor(away / 86400) AS BIGINT) END AS days_away,
  CASE WHEN matched = 0 THEN CASE WHEN us_ts < TIMESTAMP '{last}' THEN 'before' ELSE 'after' END END AS side
FROM best
"""


@query("q_last_by_month_hit", _by_month(1997, 5, "1997-05-31 23:59:59"))
def _(spark, sf):
    return date_jobs.find_last_by_month(fx.dates(spark, sf), "us12", 1997, 5).drop("file", "ord")


@query("q_last_by_month_miss", _by_month(2005, 1, "2005-01-31 23:59:59"))
def _(spark, sf):
    return date_jobs.find_last_by_month(fx.dates(spark, sf), "us12", 2005, 1).drop("file", "ord")


@query("q_sort_by_date", f"""
WITH {fx.DATES} SELECT id, us12, row_number() OVER (ORDER BY us_ts DESC NULLS LAST, k) AS place FROM parsed
""")
def _(spark, sf):
    rows = fx.dates(spark, sf).select("id", "us12", ROW_NO)
    return date_jobs.sort_by_date(rows, "us12", numbered=True).select("id", "us12", "place")


_RELATIONS = """
WITH relations AS (
  SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') WHEN 2 THEN '' ELSE strftime(o_orderdate, '%d/%m/%Y') END AS FechaIngreso
  FROM orders)
"""


@query("q_relation_dates", f"""{_RELATIONS}
SELECT k + 2 AS line, 'FechaIngreso' AS field, FechaIngreso AS value, o_orderpriority AS file, k + 1 AS ord
FROM relations JOIN orders ON o_orderkey = k WHERE k % 4 = 3
""")
def _(spark, sf):
    plain = F.col("o_orderdate").cast("string")
    turn = F.col("o_orderkey") % 4
    slashed = F.concat_ws("/", F.substring(plain, 9, 2), F.substring(plain, 6, 2), F.substring(plain, 1, 4))
    relations = fx.table(spark, sf, "orders").select(
        F.when(turn == 0, F.substring(plain, 1, 10)).when(turn == 1, plain).when(turn == 2, "").otherwise(slashed)
        .alias("FechaIngreso"),
        (F.col("o_orderkey") + 1).alias(ROW_NO), F.col("o_orderpriority").alias("_file"),
        (F.col("o_orderkey") + 1).alias("_ord"),
    )
    return date_jobs.check_relation_dates(relations, ["FechaIngreso"]).rejects


# ---------------------------------------------------------------- files written and read back

@query("q_normalize_header", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _(spark, sf):
    named = fx.table(spark, sf, "customer").select(
        F.col("c_custkey").alias('"c_custkey"'), F.col("c_name").alias('"c_name"'), "c_mktsegment"
    )
    return normalize_header(named)


@query("q_manifest", """
SELECT '/exports/' || s_name || '.csv' AS path FROM supplier WHERE s_suppkey % 4 > 1
""")
def _(spark, sf):
    """Suppliers as manifest entries: comments, blank lines, padded and plain paths."""
    folder = new_folder(spark)
    name = F.concat(F.lit("/exports/"), "s_name", F.lit(".csv"))
    turn = F.col("s_suppkey") % 4
    entry = F.when(turn == 0, F.concat(F.lit(" # "), name)).when(turn == 1, "   ").when(
        turn == 2, F.concat(F.lit("  "), name, F.lit("\t"))).otherwise(name)
    fx.table(spark, sf, "supplier").select(entry.alias("value")).write.text(folder)
    return line_source.manifest_entries(spark, folder).select("path")


_CUSTOMERS = TableModel("customers", ("key", "rank", "name", "segment"), ("key",), ("key", "rank"))


# Nations as files of their customers: with the model's header, with another one, or with none.
_NATION_FILES = f"""
nation_files AS (
  SELECT n_nationkey, n_name, CASE n_nationkey % 4 WHEN 0 THEN '{_CUSTOMERS.header}' WHEN 2 THEN 'id,' || lower(n_comment_free) END AS own
  FROM (SELECT *, 'name of ' || n_name AS n_comment_free FROM nation)),
first_lines AS (
  SELECT n_nationkey, n_name, coalesce(own, arg_min(CAST(c_custkey AS VARCHAR) || ',1,' || c_name || ',' || c_mktsegment, c_custkey)) AS line
  FROM nation_files JOIN customer ON n_nationkey = c_nationkey GROUP BY n_nationkey, n_name, own),
foreign_files AS (
  SELECT * FROM first_lines WHERE trim(line) <> '{_CUSTOMERS.header}'
    AND len(list_filter(string_split(line, ','), lambda x: trim(x) = '' OR regexp_full_match(trim(x), '{_FLOAT}'))) = 0)
"""


def _nation_lines(spark, sf):
    turn, name = F.col("n_nationkey") % 4, F.concat(F.lit("id,name of "), F.col("n_name"))
    nations = fx.table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("file_ord"), F.col("n_name").alias("file"),
        F.when(turn == 0, _CUSTOMERS.header).when(turn == 2, F.lower(name)).alias("own"))
    customers = fx.table(spark, sf, "customer").withColumnRenamed("c_nationkey", "file_ord")
    tops = customers.groupBy("file_ord").agg(F.min("c_custkey").alias("top"))
    first = F.col("own").isNull() & (F.col("c_custkey") == F.col("top"))
    data = customers.join(nations, "file_ord").join(tops, "file_ord").select(
        "file", "file_ord", F.when(first, 1).otherwise(F.col("c_custkey") + 2).alias("line_no"),
        F.concat_ws(",", F.col("c_custkey").cast("string"), F.lit("1"), "c_name", "c_mktsegment").alias("line"))
    filled = nations.join(tops, "file_ord").filter("own IS NOT NULL")
    own = filled.select("file", "file_ord", F.lit(1).cast("bigint").alias("line_no"), F.col("own").alias("line"))
    return line_source.line_table(data.unionByName(own), "file", "file_ord", "line_no", "line")


@query("q_batch_add_headers", f"""
WITH {_NATION_FILES}
SELECT n_name AS file_name, CAST(c_custkey AS VARCHAR) AS key, '1' AS rank, c_name AS name, c_mktsegment AS segment
FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_nationkey NOT IN (SELECT n_nationkey FROM foreign_files)
""")
def _(spark, sf):
    folder = new_folder(spark)
    headers.batch_add_headers(_nation_lines(spark, sf), _CUSTOMERS, folder)
    written = spark.read.option("header", True).csv(folder)
    return written.select("file_name", "key", "rank", "name", "segment")


@query("q_batch_foreign_headers", f"WITH {_NATION_FILES} SELECT n_name AS file, line AS header FROM foreign_files")
def _(spark, sf):
    return headers.batch_add_headers(_nation_lines(spark, sf), _CUSTOMERS, new_folder(spark))


@query("q_file_records", f"WITH {fx.DEBTORS} SELECT {_CELLS} FROM debtors")
def _(spark, sf):
    folder = new_folder(spark)
    write_records(fx.debtors(spark, sf), folder)
    return read_records(spark, folder).select(*MOROSOS.columns)


@query("q_file_lines", """
SELECT count(*) AS lines, count(DISTINCT o_orderkey) AS places, true AS in_order FROM orders
""")
def _(spark, sf):
    """Range-sorted lines come back numbered in order over many files and blocks."""
    folder = new_folder(spark)
    lines = fx.debtor_lines(spark, sf).select(F.format_string("%012d,%s", "line_no", "line").alias("line"))
    write_lines(lines.orderBy("line"), folder, header="line_no,line")
    found = line_source.read_lines(spark, folder).filter("line_no > 1").select(
        "file", "ord", "line_no", F.substring("line", 1, 12).cast("bigint").alias("written")
    )
    # Inside a file both numbers move by one; across files order is kept.
    per_file = found.groupBy("file").agg(
        F.count("*").alias("lines"), F.min("ord").alias("from_ord"),
        (F.max("written") - F.min("written")).alias("span"), F.max("line_no").alias("last"),
        (F.max(F.col("written") - F.col("line_no")) - F.min(F.col("written") - F.col("line_no"))).alias("drift"),
    )
    return per_file.agg(
        F.sum("lines").alias("lines"), F.sum(F.col("span") + 1).alias("places"),
        (F.count_if((F.col("drift") != 0) | (F.col("lines") != F.col("last") - 1)) == 0).alias("in_order"),
    )


@query("q_file_chunks", f"""
WITH {fx.DEBTORS} SELECT 'part_' || lpad(CAST(k // 2000 + 1 AS VARCHAR), 3, '0') AS chunk, count(*) AS records,
  min(CAST(IdTransmit AS BIGINT)) AS first_id, max(CAST(IdTransmit AS BIGINT)) AS last_id
FROM debtors GROUP BY 1
""")
def _(spark, sf):
    folder = new_folder(spark)
    write_chunks(slices.split_chunks(fx.debtors(spark, sf), 2000), folder, "part")
    written = spark.read.option("header", True).option("escape", '"').csv(folder)
    place = F.col("IdTransmit").cast("bigint")
    return written.groupBy("chunk").agg(
        F.count("*").alias("records"), F.min(place).alias("first_id"), F.max(place).alias("last_id")
    )


# ---------------------------------------------------------------- ragged and unreadable records

_SOUND = f"WITH {fx.BROKEN_LINES}"


@query("q_filter_ragged", f"{_SOUND} SELECT k + 1 AS row_no, Cuil, IdTransmit FROM broken_lines WHERE unsound IS NULL AND CreateUser = 'user1'")
def _(spark, sf):
    found = slices.filter_equals(fx.broken_debtors(spark, sf), "CreateUser", "user1")
    return found.select(F.col(ROW_NO).alias("row_no"), "Cuil", "IdTransmit")


@query("q_unsound_rows", f"""{_SOUND}
SELECT k + 2 AS line, unsound AS error_type, broken_lines.line AS record FROM broken_lines WHERE unsound IS NOT NULL
""")
def _(spark, sf):
    return unsound_rows(fx.broken_debtors(spark, sf)).select("line", "error_type", "record")


@query("q_delete_from_row_ragged", f"{_SOUND} SELECT k + 1 AS row_no, RazonSocial FROM broken_lines WHERE unsound IS NULL AND k + 2 < 9000")
def _(spark, sf):
    return slices.delete_from_row(fx.broken_debtors(spark, sf), 9000).select(F.col(ROW_NO).alias("row_no"), "RazonSocial")


_ALIKE = {"IdTransmit": "1", "CreateDate": "", "Periodo": "199701", "NroDoc": "7"}
_ALIKE_CELLS = ", ".join(f"'{_ALIKE[name]}' AS {name}" if name in _ALIKE else name for name in MOROSOS.columns)


def _alike(spark, sf):
    return fx.broken_debtors(spark, sf).withColumns({name: F.lit(value) for name, value in _ALIKE.items()})


@query("q_dedup_records_ragged", f"{_SOUND} SELECT DISTINCT {_ALIKE_CELLS} FROM broken_lines WHERE unsound IS NULL")
def _(spark, sf):
    return merge.dedup_records(_alike(spark, sf))


@query("q_merge_records_ragged", f"""{_SOUND}
SELECT {_ALIKE_CELLS} FROM broken_lines WHERE unsound IS NULL
UNION SELECT {_CELLS} FROM broken_lines WHERE unsound IS NULL AND k % 3 = 0
""")
def _(spark, sf):
    third = fx.broken_debtors(spark, sf).filter((F.col(ROW_NO) - 1) % 3 == 0)
    return merge.merge_records_dedup([_alike(spark, sf), third])


@query("q_convert_date_ragged", f"""{_SOUND}
SELECT k + 2 AS line, coalesce(unsound, 'DATE_CONVERSION_ERROR') AS error_type FROM broken_lines WHERE unsound IS NOT NULL OR k % 7 = 0
""")
def _(spark, sf):
    day = F.when((F.col(ROW_NO) - 1) % 7 == 0, "soon").otherwise("2024-01-05T10:20:30")
    rows = fx.broken_debtors(spark, sf).withColumn("CreateDate", day)
    return date_jobs.convert_date(rows, "CreateDate").rejects.select("line", "error_type")


@query("q_field_errors_ragged", f"""{_SOUND}, bad AS ({_bad_cells(_strict, "broken_lines", "coalesce(unsound, '') <> 'PARSE_ERROR'")})
SELECT field, count(*) AS errors FROM bad GROUP BY field
""")
def _(spark, sf):
    return quality.field_error_counts(fx.broken_debtors(spark, sf), MOROSOS, rule="strict38")


@query("q_keys_rejects", f"{_SOUND} SELECT k + 1 AS record, unsound AS error_type FROM broken_lines WHERE unsound IS NOT NULL")
def _(spark, sf):
    return quality.extract_keys(fx.broken_debtors(spark, sf), MOROSOS).rejects.select("record", "error_type")


@query("q_resume_rejects", f"""{_SOUND},
reasons AS (
  SELECT k + 1 AS record, CASE WHEN unsound IS NOT NULL THEN unsound WHEN NOT {_I32.format('IdTransmit')} THEN 'IdTransmit is no 32-bit integer'
    WHEN NOT {_I32.format('IdCliente')} THEN 'IdCliente is no 32-bit integer' END AS error_type FROM broken_lines)
SELECT * FROM reasons WHERE error_type IS NOT NULL
""")
def _(spark, sf):
    return quality.extract_resume_key(fx.broken_debtors(spark, sf)).rejects.select("record", "error_type")


# ---------------------------------------------------------------- several files

@query("q_rejects_by_file", f"""{_SOUND},
bad AS ({_bad_cells(_strict, "broken_lines", "unsound IS NULL").replace("k + 2 AS line", "k")})
SELECT file, file_line AS line, field, value FROM bad JOIN {fx.TWO_FILES} f ON bad.k = f.k
""")
def _(spark, sf):
    rows = parse_lines(fx.two_files(spark, sf), list(MOROSOS.columns), header=False)
    rejects = quality.sanitize_for_import(rows, MOROSOS, rule="strict38").rejects
    return rejects.filter("error_type = 'INVALID_NUMERIC'").select("file", "line", "field", "value")


@query("q_chunks_by_file", f"""{_SOUND}
SELECT file, (file_line - 2) // 500 + 1 AS chunk_id, count(*) AS records, min(k) AS first_k, max(k) AS last_k
FROM {fx.TWO_FILES} f WHERE unsound IS NULL GROUP BY 1, 2
""")
def _(spark, sf):
    rows = parse_lines(fx.two_files(spark, sf), list(MOROSOS.columns), header=False)
    k = F.regexp_replace("IdTransmit", "^0(?=.)", "").cast("bigint")
    return slices.split_chunks(quality.drop_ragged(rows).clean, 500).groupBy(
        F.col("_file").alias("file"), F.col("_chunk_id").alias("chunk_id")
    ).agg(F.count("*").alias("records"), F.min(k).alias("first_k"), F.max(k).alias("last_k"))


def _tied_dates(spark, sf):
    """Every row has one of four days, in two files of which the odd rows' comes first."""
    k = F.col(ROW_NO) - 1
    day = F.concat(F.lit("01/0"), (k % 4 + 1).cast("string"), F.lit("/2024 10:00:00 AM"))
    place = F.expr(f"({ROW_NO} - 1) div 2 + 1")
    return fx.dates(spark, sf).select(
        "id", day.alias("day"), F.when(k % 2 == 1, "odd").otherwise("even").alias("_file"),
        line_source.ordinal((k + 1) % 2, place).alias("_ord"), place.alias(ROW_NO))


@query("q_oldest_over_files", f"""
WITH {fx.DATES},
tied AS (SELECT id, k % 4 + 1 AS day, (k + 1) % 2 AS file_ord, k // 2 + 1 AS place FROM dates),
best AS (SELECT * FROM tied ORDER BY day, file_ord, place LIMIT 1)
SELECT '2024-01-0' || CAST(day AS VARCHAR) || 'T10:00:00' AS date, place + 1 AS line,
  id || ' | 01/0' || CAST(day AS VARCHAR) || '/2024 10:00:00 AM' AS preview, (SELECT count(*) FROM tied) AS processed,
  CASE WHEN file_ord = 0 THEN 'odd' ELSE 'even' END AS file, file_ord * 1099511627776 + place AS ord FROM best
""")
def _(spark, sf):
    return date_jobs.find_oldest(_tied_dates(spark, sf), "day").select("date", "line", "preview", "processed", "file", "ord")


@query("q_newest_over_files", f"""
WITH {fx.DATES},
tied AS (SELECT id, k % 4 + 1 AS day, (k + 1) % 2 AS file_ord, k // 2 + 1 AS place FROM dates),
best AS (SELECT * FROM tied ORDER BY day DESC, file_ord, place LIMIT 1)
SELECT id, '2024-01-0' || CAST(day AS VARCHAR) || 'T10:00:00' AS date,
  CASE WHEN file_ord = 0 THEN 'odd' ELSE 'even' END AS file, file_ord * 1099511627776 + place AS ord FROM best
""")
def _(spark, sf):
    newest = date_jobs.find_newest(_tied_dates(spark, sf), "day")
    return newest.select(F.split("preview", " ")[0].alias("id"), "date", "file", "ord")


# ---------------------------------------------------------------- more spellings and models

_MDY = """
spelled AS (
  SELECT o_orderpriority, o_orderkey AS k, o_orderdate + to_seconds((o_orderkey * 61) % 86400) AS ts FROM orders),
mdy AS (SELECT *, CASE WHEN k % 10 = 0 THEN NULL WHEN k % 4 = 1 THEN date_trunc('day', ts) ELSE ts END AS moment FROM spelled)
"""


def _mdy(spark, sf):
    """Month-first dates on a 24-hour clock: some without time, some behind a counter, some unreadable."""
    plain = fx._dated_orders(spark, sf)
    k = F.col("k")
    day = F.concat(F.substring("plain", 6, 2), F.lit("/"), F.substring("plain", 9, 2), F.lit("/"), F.substring("plain", 1, 4))
    timed = F.concat(day, F.lit(" "), F.substring("plain", 12, 8))
    cell = F.when(k % 10 == 0, "13/45/2024").when(k % 4 == 1, day).when(k % 4 == 2, F.concat(F.lit("1,"), timed)).otherwise(timed)
    return plain.select(F.col("o_orderpriority").alias("_file"), cell.alias("day"))


@query("q_find_latest_mdy", f"""
WITH {_MDY} SELECT strftime(max(moment), '%Y-%m-%dT%H:%M:%S') AS latest, count(moment) AS valid, count(*) - count(moment) AS invalid FROM mdy
""")
def _(spark, sf):
    return date_jobs.find_latest(_mdy(spark, sf), "day")


def _mdy_by_priority(pick: str, name: str) -> str:
    return f"""
WITH {_MDY} SELECT CASE WHEN grouping(o_orderpriority) = 1 THEN 'TOTAL' ELSE o_orderpriority END AS file,
  strftime({pick}(moment), '%Y-%m-%dT%H:%M:%S') AS {name}, count(moment) AS valid FROM mdy GROUP BY ROLLUP (o_orderpriority)
"""


@query("q_latest_batch_mdy", _mdy_by_priority("max", "latest"))
def _(spark, sf):
    return date_jobs.find_latest_batch(_mdy(spark, sf), "day")


@query("q_earliest_batch_mdy", _mdy_by_priority("min", "earliest"))
def _(spark, sf):
    return date_jobs.find_earliest_batch(_mdy(spark, sf), "day")


@query("q_sort_by_mixed_dates", f"""
WITH {fx.DATES} SELECT id, row_number() OVER (ORDER BY iso NULLS LAST, k) AS place FROM parsed
""")
def _(spark, sf):
    rows = fx.dates(spark, sf).select("id", "raw", ROW_NO)
    return date_jobs.sort_by_date(rows, "raw", order="asc", fmt="mixed", numbered=True).select("id", "place")


@query("q_validate_relations", """
WITH relations AS (
  SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 = 0 THEN '9223372036854775808' ELSE CAST(20000000000 + o_custkey AS VARCHAR) END AS Cuil,
    CASE WHEN o_orderkey % 13 = 0 THEN 'x' ELSE CAST(o_custkey AS VARCHAR) END AS Cuit,
    CASE WHEN o_orderkey % 17 = 0 THEN strftime(o_orderdate, '%d/%m/%Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS FechaIngreso, '' AS FechaBaja
  FROM orders)
SELECT k + 2 AS line, 'Cuil' AS field, 'Cuil is no 64-bit integer: ' || Cuil AS details FROM relations WHERE TRY_CAST(Cuil AS BIGINT) IS NULL
UNION ALL SELECT k + 2, 'Cuit', 'Cuit is no 64-bit integer: ' || Cuit FROM relations WHERE TRY_CAST(Cuit AS BIGINT) IS NULL
UNION ALL SELECT k + 2, 'FechaIngreso', 'FechaIngreso is no ISO date: ' || FechaIngreso FROM relations
  WHERE NOT regexp_full_match(FechaIngreso, '[0-9]{4}-[0-9]{2}-[0-9]{2}')
""")
def _(spark, sf):
    plain, k = F.col("o_orderdate").cast("string"), F.col("o_orderkey")
    slashed = F.concat_ws("/", F.substring(plain, 9, 2), F.substring(plain, 6, 2), F.substring(plain, 1, 4))
    rows = fx.table(spark, sf, "orders").select(
        F.when(k % 11 == 0, "9223372036854775808").otherwise((F.col("o_custkey") + 20000000000).cast("string")).alias("Cuil"),
        F.when(k % 13 == 0, "x").otherwise(F.col("o_custkey").cast("string")).alias("Cuit"),
        F.when(k % 17 == 0, slashed).otherwise(F.substring(plain, 1, 10)).alias("FechaIngreso"), F.lit("").alias("FechaBaja"),
        (k + 1).alias(ROW_NO))
    return quality.validate_model(rows, "empleadores_relaciones").rejects.select("line", "field", "details")


@query("q_validate_employers", """
WITH employers AS (
  SELECT s_suppkey AS k, CASE WHEN s_suppkey % 7 = 0 THEN 'n/a' ELSE CAST(s_suppkey AS VARCHAR) || '.5' END AS Cuit, s_name AS RazonSocial,
    CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE s_name END AS Domicilio FROM supplier)
SELECT k + 2 AS line, 'Cuit' AS field, 'Cuit is no decimal number: ' || Cuit AS details FROM employers WHERE TRY_CAST(Cuit AS DOUBLE) IS NULL
UNION ALL SELECT k + 2, 'Domicilio', 'Domicilio is empty' FROM employers WHERE Domicilio = ''
""")
def _(spark, sf):
    k = F.col("s_suppkey")
    rows = fx.table(spark, sf, "supplier").select(
        F.when(k % 7 == 0, "n/a").otherwise(F.concat(k.cast("string"), F.lit(".5"))).alias("Cuit"), F.col("s_name").alias("RazonSocial"),
        F.when(k % 5 == 0, "").otherwise(F.col("s_name")).alias("Domicilio"), F.lit("1000").alias("CodPostal"),
        F.lit("here").alias("Localidad"), F.lit("there").alias("NombreProvincia"), F.lit("").alias("Telefono"), (k + 1).alias(ROW_NO))
    return quality.validate_model(rows, "empleadores").rejects.select("line", "field", "details")


# ---------------------------------------------------------------- every line and every quote, written and read back

@query("q_merge_written", f"""{_MERGED},
kept AS (SELECT CASE WHEN line_no % 5 = 2 THEN '' ELSE line END AS line FROM merged WHERE line_no > 1)
SELECT count(*) AS lines, count(*) FILTER (WHERE line = '') AS blank, CAST(sum(strlen(line)) AS BIGINT) AS bytes, count(DISTINCT line) AS different FROM kept
""")
def _(spark, sf):
    lines = fx.document_lines(spark, sf)
    blanked = lines.withColumn("line", F.when((F.col("line_no") % 5 == 2) & (F.col("line_no") > 1), "").otherwise(F.col("line")))
    folder = new_folder(spark)
    write_lines(merge.merge(blanked).filter("line_no > 1"), folder, header="a line")
    read = line_source.read_lines(spark, folder).filter("line_no > 1")
    return read.agg(
        F.count("*").alias("lines"), F.count_if(F.col("line") == "").alias("blank"),
        F.sum(F.octet_length("line").cast("bigint")).alias("bytes"), F.count_distinct("line").alias("different"))


@query("q_non_numeric_written", f"""
WITH {fx.DEBTORS} SELECT {" || ',' || ".join(_non_numeric(name) for name in MOROSOS.columns)} AS line FROM debtors WHERE {_all(_strict)}
""")
def _(spark, sf):
    folder = new_folder(spark)
    write_records(quality.sanitize_for_import(fx.debtors(spark, sf), MOROSOS, rule="strict38").clean, folder, quote="non_numeric")
    return line_source.read_lines(spark, folder).filter("line_no > 1").select("line")


# A document is one quoted cell; its line breaks make several lines of it.
@query("q_quoted_breaks", """
WITH physical AS (
  SELECT unnest(string_split(CAST(doc_id AS VARCHAR) || ',"' || replace(text, '"', '""') || '"', chr(10))) AS line FROM documents),
cells AS (
  SELECT line, len(line) - len(replace(line, '"', '')) AS quotes, regexp_replace(line, '"[^"]*(""[^"]*)*"', '', 'g') AS bare
  FROM physical WHERE line <> ''),
sound AS (SELECT *, quotes % 2 = 0 AND len(bare) - len(replace(bare, ',', '')) = 1 AS fits FROM cells)
SELECT (SELECT count(*) FILTER (WHERE fits) FROM sound) AS split_clean, (SELECT count(*) FILTER (WHERE NOT fits) FROM sound) AS split_rejects,
  count(*) AS whole, CAST(sum(strlen(text)) AS BIGINT) AS bytes FROM documents
""")
def _(spark, sf):
    folder = new_folder(spark)
    cell = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    fx.table(spark, sf, "documents").select(F.concat_ws(",", F.col("doc_id").cast("string"), cell).alias("value")).write.text(folder)
    split = quality.drop_ragged(read_records(spark, folder, header=False, names=["id", "text"]))
    whole = read_records(spark, folder, header=False, names=["id", "text"], multi_line=True)
    return split.summary.select(
        F.col("valid").alias("split_clean"), F.col("invalid").alias("split_rejects"),
        whole.select(F.count("*")).scalar().alias("whole"),
        whole.select(F.sum(F.octet_length("text").cast("bigint"))).scalar().alias("bytes"),
    )


@query("q_quoted_breaks_split", """
SELECT CAST(doc_id AS VARCHAR) AS id, CAST(strlen(text) AS BIGINT) AS bytes, md5(text) AS digest, 2 AS cells FROM documents
""")
def _(spark, sf):
    """Whole documents as quoted cells, read back from files that split."""
    folder = new_folder(spark)
    cell = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    fx.table(spark, sf, "documents").select(F.concat_ws(",", F.col("doc_id").cast("string"), cell).alias("value")).write.text(folder)
    found = sound_rows(read_records(spark, folder, header=False, names=["id", "text"], quoted_breaks=True))
    return found.select("id", F.octet_length("text").cast("bigint").alias("bytes"), F.md5("text").alias("digest"), F.col(FIELDS).cast("int").alias("cells"))


@query("q_undecodable_rejects", r"""
WITH named AS (
  SELECT doc_id, regexp_replace(replace(left(text, 60), '"', ' '), '[,\r\n]|[^\x00-\xFF]|[\x{80}-\x{BF}]', ' ', 'g') AS name FROM documents),
lines AS (SELECT doc_id, name, CAST(doc_id AS VARCHAR) || ',' || name AS line, doc_id % 2 = 1 AND regexp_matches(name, '[^\x00-\x7F]') AS garbled FROM named)
SELECT CASE WHEN garbled THEN 'ENCODING_ERROR' ELSE 'sound' END AS outcome,
  CASE WHEN garbled THEN array_to_string([printf('%02X', unicode(letter)) FOR letter IN string_split(line, '')], '') ELSE line END AS record
FROM lines
""")
def _(spark, sf):
    """Every second record in another charset: its bytes come back in hex, the others as text."""
    folder = new_folder(spark)
    name = F.regexp_replace(F.replace(F.left("text", F.lit(60)), F.lit('"'), F.lit(" ")), r"[,\r\n]|[^\x00-\xFF]|[\x80-\xBF]", " ")
    line = F.concat_ws(",", F.col("doc_id").cast("string"), name)
    mixed = F.when(F.col("doc_id") % 2 == 1, F.encode(line, "ISO-8859-1").cast("string")).otherwise(line)
    fx.table(spark, sf, "documents").select(mixed.alias("value")).write.text(folder)
    records = read_records(spark, folder, header=False, names=["id", "name"])
    broken = unsound_rows(records).select(F.col("error_type").alias("outcome"), "record")
    return broken.unionByName(sound_rows(records).select(F.lit("sound").alias("outcome"), F.concat_ws(",", "id", "name").alias("record")))


@query("q_routed_once", f"""
WITH {fx.DEBTOR_LINES},
tagged AS (SELECT k, n_fields = 14 AS sound, ({_all(_strict)}) AS fine FROM debtor_lines)
SELECT 'clean' AS outcome, k + 2 AS line, NULL AS field FROM tagged WHERE sound AND fine
UNION ALL SELECT 'INVALID_NUMERIC', line, field FROM ({_bad_cells(_strict, 'debtor_lines', 'n_fields = 14')})
UNION ALL SELECT 'SKIPPED', k + 2, NULL FROM tagged WHERE sound AND NOT fine
UNION ALL SELECT 'IRREPARABLE_STRUCTURE', k + 2, NULL FROM tagged WHERE NOT sound
UNION ALL SELECT 'processed', count(*), NULL FROM tagged
UNION ALL SELECT 'valid', count(*) FILTER (WHERE sound AND fine), NULL FROM tagged
UNION ALL SELECT 'irreparable', count(*) FILTER (WHERE NOT sound), NULL FROM tagged
""")
def _(spark, sf):
    """Clean rows, rejects and summary out of one pass over the input."""
    found = quality.sanitize_for_import(fx.ragged_debtors(spark, sf), MOROSOS, rule="strict38").routed_once()
    nothing = F.lit(None).cast("string").alias("field")
    counts = found.summary.unpivot([], ["processed", "valid", "irreparable"], "outcome", "line")
    return (
        found.clean.select(F.lit("clean").alias("outcome"), (F.col(ROW_NO) + 1).alias("line"), nothing)
        .unionByName(found.rejects.select(F.col("error_type").alias("outcome"), "line", "field"))
        .unionByName(counts.select("outcome", "line", nothing))
    )


@query("q_compare_runs", """
WITH changed AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 AND (o_orderkey // 4096) % 3 = 1 THEN o_orderstatus || '*' ELSE o_orderstatus END AS o_orderstatus
  FROM orders WHERE o_orderkey % 5000 <> 77)
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, coalesce(a.o_orderstatus, '') AS left_value, coalesce(b.o_orderstatus, '') AS right_value
FROM orders a FULL JOIN changed b ON a.o_orderkey = b.o_orderkey
WHERE coalesce(a.o_orderstatus, '') <> coalesce(b.o_orderstatus, '')
""")
def _(spark, sf):
    """Runs of positions are summed up first; only runs that differ are joined."""
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    starred = (F.col("o_orderkey") % 10 == 0) & (F.floor(F.col("o_orderkey") / 4096) % 3 == 1)
    changed = F.when(starred, F.concat("o_orderstatus", F.lit("*"))).otherwise(F.col("o_orderstatus"))
    other = orders.filter("o_orderkey % 5000 <> 77").withColumn("o_orderstatus", changed)
    return merge.compare(orders, other, "o_orderkey", "o_orderstatus", exact=False)


# ---------------------------------------------------------------- what is kept of files read before

def _write_parts(spark, sf, folder: str, where: str) -> None:
    """Lines of documents under one header line per file, in as many files as there are tasks."""
    write_lines(fx.document_lines(spark, sf).filter(where), folder, header="a line")


@query("q_merge_dedup_grown", f"""
WITH {fx.DOC_LINES}
SELECT line, false AS is_header, true AS found_anew FROM doc_lines GROUP BY line
UNION ALL SELECT 'a line', true, true
""")
def _(spark, sf):
    """Two thirds of the documents are merged, then all: the second call reads the files that came and the kept state."""
    first, second, state = new_folder(spark), new_folder(spark), new_folder(spark)
    _write_parts(spark, sf, first, "file_ord % 3 <> 0")
    _write_parts(spark, sf, second, "file_ord % 3 = 0")
    merge.merge_dedup_grown(spark, [first], state)
    grown = merge.merge_dedup_grown(spark, [first, second], state).withColumnRenamed("ord", "kept_ord")
    anew = merge.merge_dedup(line_source.read_lines(spark, [first, second]))
    both = grown.join(anew, ["line", "is_header"], "full")
    return both.select("line", "is_header", F.col("kept_ord").eqNullSafe(F.col("ord")).alias("found_anew"))


@query("q_unique_sketch", f"""
WITH {fx.DOC_LINES}, data AS (
  SELECT line, CASE doc_id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS part FROM doc_lines WHERE line_no > 1)
SELECT part, count(DISTINCT line) AS unique_lines, true AS within FROM data GROUP BY part
UNION ALL SELECT 'all', count(DISTINCT line), true FROM data
""")
def _(spark, sf):
    """Sketches per file, united by part and over all; each within four standard errors of the exact count."""
    def part(df):
        return df.withColumn("part", F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("file").cast("bigint") % 3 + 1).cast("int")))

    lines = fx.document_lines(spark, sf)
    profile = part(kept.profile_lines(lines))
    whole = profiles.count_unique_kept(profile).select(F.lit("all").alias("part"), F.col("unique_lines").alias("estimate"))
    united = profiles.count_unique_kept(profile, ["part"]).withColumnRenamed("unique_lines", "estimate").unionByName(whole)
    data = part(lines.filter("line_no > 1"))
    exact = (
        data.select("part", "line").distinct().groupBy("part").agg(F.count("*").alias("unique_lines"))
        .unionByName(profiles.count_unique(lines).select(F.lit("all").alias("part"), "unique_lines"))
    )
    off = F.abs(F.col("estimate") - F.col("unique_lines"))
    return exact.join(united, "part").select("part", "unique_lines", (off <= 4 * 0.0082 * F.col("unique_lines") + 1).alias("within"))


@query("q_kept_headers", f"""
WITH {fx.DEBTORS} SELECT 'ok' AS status, false AS missing_header, count(*) AS records, count(*) AS again FROM debtors
""")
def _(spark, sf):
    """Headers and line counts of written files out of the kept profile; asked again, no file is read."""
    folder, state = new_folder(spark), new_folder(spark)
    write_records(fx.debtors(spark, sf).repartition("IdTransmit"), folder)
    top = kept.top_lines(kept.kept_profile(spark, folder, state))
    again = kept.top_lines(kept.kept_profile(spark, folder, state)).agg(F.sum(F.col("file_lines") - 1)).scalar()
    checked = headers.check_header(top, MOROSOS).join(headers.detect_missing_header(top), "file")
    return checked.groupBy("status", "missing_header").agg(F.sum("records").alias("records")).withColumn("again", again)
