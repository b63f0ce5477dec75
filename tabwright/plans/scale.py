"""Joins, numbering and checkpoints that hold at cluster scale."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

# A side is broadcast only when it was measured to be smaller than this.
BROADCAST_BYTES = 64 * 1024 * 1024
# Lines of one file that share a join key where the broadcast is refused.
CHUNK_LINES = 1 << 20
# monotonically_increasing_id() keeps the row position in its low 33 bits.
POSITION_BITS = (1 << 33) - 1


def measured_bytes(small: DataFrame) -> int:
    """Size of a per-file table, measured by one aggregate on the cluster."""
    width = F.lit(16)
    for column in small.schema.fields:
        if isinstance(column.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(F.col(f"`{column.name}`")), F.lit(0)) + 8
        else:
            width = width + 8
    return small.agg(F.coalesce(F.sum(width.cast("bigint")), F.lit(0)).alias("bytes")).first()["bytes"]


def attach_per_file(
    lines: DataFrame, info: DataFrame, limit: int | None = None, chunk: int | None = None
) -> DataFrame:
    """Left-join a one-row-per-file table to its lines.

    ``info`` is computed once and checkpointed, and broadcast when it was measured
    to fit.  Otherwise both sides are
    shuffled by (file, chunk of lines): the small side is repeated once for each
    chunk a file really has, so a file with a third of all lines spreads over
    many tasks and a short file is not copied.
    """
    limit = BROADCAST_BYTES if limit is None else limit
    chunk = CHUNK_LINES if chunk is None else chunk
    info = cut_lineage(info)
    if measured_bytes(info) <= limit:
        return lines.join(F.broadcast(info), "file", "left")
    extent = lines.groupBy("file").agg(F.max("line_no").alias("_last"))
    spread = info.join(extent, "file").select(
        info["*"], F.explode(F.sequence(F.lit(0), F.expr(f"_last div {chunk}"))).alias("_chunk")
    )
    return (
        lines.withColumn("_chunk", F.expr(f"line_no div {chunk}"))
        .join(spread, ["file", "_chunk"], "left")
        .drop("_chunk")
    )


def computed_once(df: DataFrame, columns: dict[str, Column], drop: tuple[str, ...] = ()) -> DataFrame:
    """Add or replace columns that later filters must not evaluate again.

    A filter is pushed through a projection by copying the column's expression
    into it.  Costly expressions (parsing, pattern matching) go through a
    generator of one row instead, which filters do not cross.
    """
    kept = [F.col(f"`{name}`") for name in df.columns if name not in columns and name not in drop]
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*kept, F.inline(F.array(row)))


def in_arrow(df: DataFrame, run: Callable[[Iterator], Iterator], schema: str) -> DataFrame:
    """``mapInArrow`` whose workers find this package beside their own path."""
    environment, root = df.sparkSession.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, root]))
    return df.mapInArrow(run, schema)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; the warehouse, which is shared too, where it names none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/tabwright-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def number_rows(df: DataFrame, order_by: list[Column], name: str) -> DataFrame:
    """Global row number in sort order without a single-task window.

    The range-sorted rows are written once, as compressed Parquet in the shared
    folder, because a second range sort may pick other bounds.  Each partition
    then needs only the number of rows before it: one row per partition, counted
    without reading the data columns.
    """
    folder = new_folder(df.sparkSession)
    df.orderBy(*order_by).select(
        "*",
        F.spark_partition_id().alias("_tw_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(POSITION_BITS)).alias("_tw_position"),
    ).write.parquet(folder)
    saved = df.sparkSession.read.parquet(folder)
    before = F.sum("_rows").over(Window.orderBy("_tw_part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = (
        saved.groupBy("_tw_part").agg(F.count("*").alias("_rows"))
        .select("_tw_part", F.coalesce(before, F.lit(0)).alias("_tw_before"))
    )
    return (
        saved.join(F.broadcast(sizes), "_tw_part")
        .withColumn(name, F.col("_tw_before") + F.col("_tw_position") + 1)
        .drop("_tw_part", "_tw_position", "_tw_before")
    )
