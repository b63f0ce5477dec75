"""Dirty tables that Spark derives from the given tables, and the same in SQL.

``k`` is ``o_orderkey``: unique, from 0, and the row order.  The tables are plans
over the given ones: nothing is stored between queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.csvtext import render_line
from tabwright.functions.dates import us12_text
from tabwright.plans.models import MOROSOS
from tabwright.plans.results import ROW_NO
from tabwright.plans.scale import computed_once
from tabwright.sources.lines import line_table
from tabwright.sources.records import parse_lines


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document is a file, each of its lines a line."""
    body = F.when(F.endswith("text", F.lit("\n")), F.expr("left(text, length(text) - 1)")).otherwise(F.col("text"))
    lines = table(spark, sf_dir, "documents").select(
        "doc_id", F.posexplode(F.split(body, "\n", -1)).alias("place", "line")
    )
    return line_table(lines.withColumn("line_no", F.col("place") + 1), "doc_id", "doc_id", "line_no", "line")


DOC_LINES = """
doc_cells AS (
  SELECT doc_id, string_split(CASE WHEN right(text, 1) = chr(10) THEN left(text, length(text) - 1) ELSE text END, chr(10)) AS cells
  FROM documents),
doc_lines AS (
  SELECT doc_id, CAST(unnest(range(1, len(cells) + 1)) AS BIGINT) AS line_no, unnest(cells) AS line FROM doc_cells)
"""
# ord = file_ord * 2**40 + line_no
ORD = "(doc_id * 1099511627776 + line_no)"


def _rest(divisor: int, equal: int) -> Column:
    return F.col("k") % divisor == equal


def _moment() -> Column:
    seconds = ((F.col("k") * 61) % 86400).cast("int")
    return F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def _dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("k", F.col("o_orderkey"))
    return computed_once(orders, {"plain": _moment().cast("string")})


def _plus(column: str, divisor: int, base: int) -> Column:
    return (F.col(column) % divisor + base).cast("string")


def debtors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Debtor records with broken numbers, in the 14-column model."""
    orders = _dated_orders(spark, sf_dir)
    cuil = (F.col("o_custkey") + 20000000000).cast("string")
    cells = {
        "Cuil": F.when(_rest(101, 7), "N/A").when(_rest(103, 9), "").otherwise(cuil),
        "IdTransmit": F.when(_rest(107, 3), F.concat(F.lit("0"), F.col("k").cast("string"))).otherwise(
            F.col("k").cast("string")),
        "NroDoc": _plus("o_custkey", 5000, 30000000),
        "ApellidoNombre": F.when(_rest(89, 5), "").otherwise(F.concat(F.lit("NAME "), _plus("o_custkey", 97, 0))),
        "IdCliente": F.when(_rest(109, 11), "1e3").otherwise(_plus("o_custkey", 5, 1)),
        "IdRegion": F.when(_rest(113, 2), "+4").otherwise(_plus("o_custkey", 8, 1)),
        "RazonSocial": F.col("o_orderpriority"),
        "Telefono": F.lit(""),
        "NombreRegion": F.concat(F.lit("REGION "), _plus("o_custkey", 8, 0)),
        "NombreCategoria": F.col("o_orderstatus"),
        "Periodo": F.translate(F.substring("plain", 1, 7), "-", ""),
        "IdEntidad": F.when(_rest(127, 1), "9" * 39).otherwise(_plus("o_custkey", 100, 400)),
        "CreateDate": us12_text(F.col("plain")),
        "CreateUser": F.concat(F.lit("user"), _plus("o_custkey", 4, 0)),
    }
    return orders.select(*[cell.alias(name) for name, cell in cells.items()], (F.col("k") + 1).alias(ROW_NO))


DEBTORS = """
debtors AS (
  SELECT
    CASE WHEN o_orderkey % 101 = 7 THEN 'N/A' WHEN o_orderkey % 103 = 9 THEN ''
         ELSE CAST(20000000000 + o_custkey AS VARCHAR) END AS Cuil,
    CASE WHEN o_orderkey % 107 = 3 THEN '0' || CAST(o_orderkey AS VARCHAR) ELSE CAST(o_orderkey AS VARCHAR) END AS IdTransmit,
    CAST(30000000 + o_custkey % 5000 AS VARCHAR) AS NroDoc,
    CASE WHEN o_orderkey % 89 = 5 THEN '' ELSE 'NAME ' || CAST(o_custkey % 97 AS VARCHAR) END AS ApellidoNombre,
    CASE WHEN o_orderkey % 109 = 11 THEN '1e3' ELSE CAST(1 + o_custkey % 5 AS VARCHAR) END AS IdCliente,
    CASE WHEN o_orderkey % 113 = 2 THEN '+4' ELSE CAST(1 + o_custkey % 8 AS VARCHAR) END AS IdRegion,
    o_orderpriority AS RazonSocial, '' AS Telefono,
    'REGION ' || CAST(o_custkey % 8 AS VARCHAR) AS NombreRegion, o_orderstatus AS NombreCategoria,
    strftime(o_orderdate, '%Y%m') AS Periodo,
    CASE WHEN o_orderkey % 127 = 1 THEN repeat('9', 39) ELSE CAST(400 + o_custkey % 100 AS VARCHAR) END AS IdEntidad,
    strftime(o_orderdate + to_seconds((o_orderkey * 61) % 86400), '%m/%d/%Y %I:%M:%S %p') AS CreateDate,
    'user' || CAST(o_custkey % 4 AS VARCHAR) AS CreateUser,
    o_orderkey AS k
  FROM orders)
"""


def debtor_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The debtor records as lines of one headerless file, some of them ragged."""
    records = debtors(spark, sf_dir).withColumn("k", F.col(ROW_NO) - 1)
    records = records.withColumn(
        "RazonSocial", F.when(_rest(139, 8), "A, B").otherwise(F.col("RazonSocial"))
    )
    records = computed_once(records, {"short": render_line(list(MOROSOS.columns[:-1]))})
    short, full = F.col("short"), F.concat_ws(",", "short", "CreateUser")
    line = F.when(_rest(131, 4), short).when(_rest(137, 6), F.concat(full, F.lit(",x"))).otherwise(full)
    place = F.col("k") + 1
    return records.select(
        F.lit("debtors").alias("file"), F.lit(0).cast("bigint").alias("file_ord"),
        place.alias("line_no"), place.alias("ord"), line.alias("line"),
    )


def ragged_debtors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_lines(debtor_lines(spark, sf_dir), list(MOROSOS.columns), header=False)


_PLAIN = " || ',' || ".join(
    "CASE WHEN k % 139 = 8 THEN '\"A, B\"' ELSE RazonSocial END" if name == "RazonSocial" else name
    for name in MOROSOS.columns[:-1]
)
DEBTOR_LINES = f"""{DEBTORS},
debtor_lines AS (
  SELECT *,
    CASE WHEN k % 131 = 4 THEN 13 WHEN k % 137 = 6 THEN 15 ELSE 14 END AS n_fields,
    {_PLAIN} || CASE WHEN k % 131 = 4 THEN '' WHEN k % 137 = 6 THEN ',' || CreateUser || ',x' ELSE ',' || CreateUser END AS line
  FROM debtors)
"""


def broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ragged lines, some of them with a quote that nothing closes."""
    k = F.col("line_no") - 1
    return debtor_lines(spark, sf_dir).withColumn(
        "line", F.when(k % 149 == 10, F.replace("line", F.lit(",user"), F.lit(',"user'))).otherwise(F.col("line"))
    )


def broken_debtors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_lines(broken_lines(spark, sf_dir), list(MOROSOS.columns), header=False)


BROKEN_LINES = f"""{DEBTOR_LINES},
broken_lines AS (
  SELECT * REPLACE (CASE WHEN k % 149 = 10 THEN replace(line, ',user', ',"user') ELSE line END AS line,
    CASE WHEN k % 139 = 8 THEN 'A, B' ELSE RazonSocial END AS RazonSocial),
    CASE WHEN n_fields <> 14 THEN 'COLUMN_COUNT' WHEN k % 149 = 10 THEN 'PARSE_ERROR' END AS unsound
  FROM debtor_lines)
"""


def two_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The broken lines dealt to two files: the odd ones come first."""
    k = F.col("line_no") - 1
    return line_table(
        broken_lines(spark, sf_dir).select(
            F.when(k % 2 == 1, "odd").otherwise("even").alias("file"), ((k + 1) % 2).alias("file_ord"),
            F.expr("(line_no - 1) div 2 + 1").alias("line_no"), "line"),
        "file", "file_ord", "line_no", "line")


TWO_FILES = """(SELECT *, CASE WHEN k % 2 = 1 THEN 'odd' ELSE 'even' END AS file, k // 2 + 2 AS file_line FROM broken_lines)"""


def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates in nine spellings (``raw``), as US text (``us12``) and as day/month/year (``cell``)."""
    orders = _dated_orders(spark, sf_dir)
    plain = F.col("plain")
    year, month, day = F.substring(plain, 1, 4), F.substring(plain, 6, 2), F.substring(plain, 9, 2)
    minutes, seconds = F.substring(plain, 12, 5), F.substring(plain, 12, 8)
    slash, blank, t = F.lit("/"), F.lit(" "), F.lit("T")
    ymd = F.substring(plain, 1, 10)
    spellings = [
        F.concat(ymd, t, seconds), F.concat(ymd, t, minutes),
        F.concat(day, slash, month, slash, year, blank, seconds), F.concat(day, slash, month, slash, year, blank, minutes),
        F.concat(month, slash, day, slash, year, blank, seconds), F.concat(month, slash, day, slash, year, blank, minutes),
        F.lit(""), F.lit("31/02/2024 10:00:00"),
    ]
    raw = F.lit("not a date")
    for rest, spelling in reversed(list(enumerate(spellings))):
        raw = F.when(_rest(9, rest), spelling).otherwise(raw)
    return orders.select(
        F.col("k").cast("string").alias("id"),
        raw.alias("raw"),
        F.when(_rest(50, 0), "bad").otherwise(us12_text(plain)).alias("us12"),
        F.when(_rest(10, 0), "hello").otherwise(F.concat(day, slash, month, slash, year)).alias("cell"),
        F.col("o_orderpriority").alias("priority"),
        (F.col("k") + 1).alias(ROW_NO),
    )


DATES = """
moments AS (SELECT *, o_orderkey AS k, o_orderdate + to_seconds((o_orderkey * 61) % 86400) AS ts FROM orders),
dates AS (
  SELECT k, CAST(k AS VARCHAR) AS id, ts, o_orderpriority AS priority,
    CASE k % 9
      WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M')
      WHEN 2 THEN strftime(ts, '%d/%m/%Y %H:%M:%S') WHEN 3 THEN strftime(ts, '%d/%m/%Y %H:%M')
      WHEN 4 THEN strftime(ts, '%m/%d/%Y %H:%M:%S') WHEN 5 THEN strftime(ts, '%m/%d/%Y %H:%M')
      WHEN 6 THEN '' WHEN 7 THEN '31/02/2024 10:00:00' ELSE 'not a date' END AS raw,
    CASE WHEN k % 50 = 0 THEN 'bad' ELSE strftime(ts, '%m/%d/%Y %I:%M:%S %p') END AS us12,
    CASE WHEN k % 10 = 0 THEN 'hello' ELSE strftime(ts, '%d/%m/%Y') END AS cell
  FROM moments),
parsed AS (
  SELECT *,
    strftime(coalesce(
      try_strptime(raw, '%Y-%m-%dT%H:%M:%S'), try_strptime(raw, '%Y-%m-%dT%H:%M'),
      try_strptime(raw, '%d/%m/%Y %H:%M:%S'), try_strptime(raw, '%d/%m/%Y %H:%M'),
      try_strptime(raw, '%m/%d/%Y %H:%M:%S'), try_strptime(raw, '%m/%d/%Y %H:%M')), '%Y-%m-%dT%H:%M:%S') AS iso,
    try_strptime(us12, '%m/%d/%Y %I:%M:%S %p') AS us_ts
  FROM dates)
"""


def header_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer plays a file: a header line with a typical fault, then a data line."""
    names = MOROSOS.columns
    variants = [
        ",".join(names),
        ",".join(names[:-1]),
        ",".join((*names[:-1], "CreatedBy")),
        ",".join((*names, names[0])),
    ]
    key = F.col("c_custkey")
    data = F.concat_ws(",", key.cast("string"), F.lit("1"), F.col("c_name"), F.col("c_mktsegment"))
    header = data
    for rest, variant in enumerate(variants):
        header = F.when(key % 5 == rest, F.lit(variant)).otherwise(header)
    lines = table(spark, sf_dir, "customer").select(
        "c_custkey", F.posexplode(F.array(header, data)).alias("place", "line")
    )
    return line_table(lines.withColumn("line_no", F.col("place") + 1), "c_custkey", "c_custkey", "line_no", "line")


_NAMES = ",".join(MOROSOS.columns)
_SHORT = ",".join(MOROSOS.columns[:-1])
HEADER_FILES = f"""
header_files AS (
  SELECT CAST(c_custkey AS VARCHAR) AS file, c_custkey,
    CAST(c_custkey AS VARCHAR) || ',1,' || c_name || ',' || c_mktsegment AS data,
    CASE c_custkey % 5
      WHEN 0 THEN '{_NAMES}' WHEN 1 THEN '{_SHORT}' WHEN 2 THEN '{_SHORT},CreatedBy' WHEN 3 THEN '{_NAMES},{MOROSOS.columns[0]}'
      ELSE CAST(c_custkey AS VARCHAR) || ',1,' || c_name || ',' || c_mktsegment END AS header
  FROM customer)
"""
