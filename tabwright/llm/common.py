"""What the text operators share: words, bound names, staged tables and connected components."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words are runs of anything but space and the five ASCII control blanks.
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
BLANK_CHARS = " \t\n\x0b\f\r"


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BLANK + "+"), lambda word: word != "")


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` names it.

    Lambda bodies that mention a column's expression would evaluate it for each
    element; here they see a bound variable.
    """
    return F.transform(F.array(value), use)[0]


def sheltered(df: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """The rows under names of our own, and each input column by its former name.

    An operator's own columns can then not clash with columns of its input, and
    columns that are not asked for again are still pruned from the scan.
    """
    names = {name: f"_in{place}" for place, name in enumerate(df.columns)}
    return df.toDF(*names.values()), {name: F.col(inner).alias(name) for name, inner in names.items()}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Where the session names none (tests, one machine), the warehouse folder is used.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"


def staged(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back, so that lost executors cost no recomputation."""
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` whose Python workers find this package beside their own path."""
    environment, root = df.sparkSession.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, root]))
    return df.mapInArrow(run, schema)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: one row (node, root) per node, root the smallest node.

    Each round hooks every node to its smallest neighbour, follows that pointer
    once more and contracts the edges, so at least half of the nodes that still
    have edges go; rounds grow with the logarithm of the nodes.  Hubs are
    reduced by map-side minima, and nothing but edge counts reaches the driver.
    """
    edges = staged(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node"))
    while not edges.isEmpty():
        hooked = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up"))
        further = hooked.select(F.col("node").alias("up"), F.col("up").alias("top"))
        hooked = staged(
            hooked.join(further, "up", "left").select("node", F.coalesce("top", "up").alias("top"))
        )
        labels = staged(
            labels.join(hooked.withColumnRenamed("node", "root"), "root", "left")
            .select("node", F.coalesce("top", "root").alias("root"))
        )
        first = hooked.select(F.col("node").alias("a"), F.col("top").alias("a_top"))
        second = hooked.select(F.col("node").alias("b"), F.col("top").alias("b_top"))
        moved = (
            edges.join(first, "a", "left").join(second, "b", "left")
            .select(F.coalesce("a_top", "a").alias("x"), F.coalesce("b_top", "b").alias("y"))
        )
        edges = staged(
            moved.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        )
    return labels
