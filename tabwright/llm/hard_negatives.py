"""Hard negatives: for each anchor and positive, close rows of another label that are not too close.

Components x become floor(scale * x), a row's score is its integer inner product
with the anchor.  Rows are dealt to blocks by a hash; the anchors visit every
block, where ``threshold_index`` answers them with thresholds that fall until
their windows are full.  The first pass finds each anchor's closest rows of its
own label (blocks by label, so it meets no other), the second the rows of other
labels in the windows that the positives' scores set.  Blocks give their first
rows; ranks over all blocks keep the first of these.

Copies: of rows with equal label and vector only the first positives + 1 by id
can ever be returned, so only they are searched; the others are still anchors.

Defined cases: rows with a null id, label or vector, or with a null, NaN or
infinite component, take no part.  A shorter vector counts as followed by zeros;
an empty one scores 0 with all.  A repeated row is a row of its own: it can be a
positive of its copy, and as an anchor it is answered twice.  A negative score
of a positive leaves an empty window.  Without anchors, or in an empty table,
the result is empty.  Only the three named columns are read, so others cannot
clash.  A component or score beyond 64 bits ends the job with an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.llm.common import mapped, staged
from tabwright.llm.threshold_index import Block, padded

# Components a block holds at most (32 MB as 64-bit numbers), and at least where there are tasks to spare.
BLOCK_COMPONENTS = 1 << 22
LEAST_COMPONENTS = 1 << 18
# Queries that are answered together.
TOGETHER = 64
FAR = 1 << 62


def vector_rows(df: DataFrame, vec_id: str, vector: str, label: str, scale: int) -> DataFrame:
    """(id, label, vec) of the rows that take part, components as whole numbers."""
    x = F.col(vector)
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    wide = F.raise_error(F.lit("a scaled component leaves 64 bits")).cast("bigint")
    whole = F.transform(x, lambda v: F.when(F.abs(v.cast("double") * scale) < float(FAR), F.floor(v.cast("double") * scale)).otherwise(wide))
    return df.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & x.isNotNull() & sound).select(
        F.col(vec_id).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"),
        whole.cast("array<bigint>").alias("vec"),
    )


def blocks_of(rows: DataFrame) -> int:
    size = rows.agg(F.coalesce(F.sum(F.size("vec") + 1), F.lit(0)).alias("n")).first()["n"]
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-size // BLOCK_COMPONENTS), min(tasks, size // LEAST_COMPONENTS))


def searched(rows: DataFrame, queries: DataFrame, blocks: int, need: int, same: bool, ratio: tuple[int, int] | None) -> DataFrame:
    """(q, top, id, score): per query and window its first ``need`` rows of each block.

    ``rows`` (id, label, vec); ``queries`` (q, label, vec, tops).  A window reaches from
    ceil(ratio * top) to top, or over everything without ``ratio``.
    """
    part = F.col("label") if same else F.lit(0).cast("bigint")
    stored = rows.select(
        F.pmod(F.xxhash64("id", "vec"), F.lit(blocks)).cast("int").alias("block"), part.alias("part"), F.lit(0).alias("kind"),
        F.col("id").alias("key"), "label", "vec", F.array().cast("array<bigint>").alias("tops"),
    )
    asked = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), part.alias("part"), F.lit(1).alias("kind"),
        F.col("q").alias("key"), "label", "vec", "tops",
    )
    # A block's rows come first in its task, then the queries in a stream.
    met = stored.unionByName(asked).repartition(blocks, "block").sortWithinPartitions("block", "part", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _answers(batches, need, same, ratio):
            yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in zip(*found)], ["q", "top", "id", "score"])

    return mapped(met, run, "q long, top long, id long, score long")


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())


def _answers(batches, need, same, ratio) -> Iterator[list[tuple[int, int, int, int]]]:
    here, pending, block = None, [], None
    for batch in batches:
        columns = {name: batch.column(name) for name in batch.schema.names}
        where = np.stack([columns[name].to_numpy().astype(np.int64) for name in ("block", "part", "kind")], axis=1)
        turns = np.flatnonzero((where[1:] != where[:-1]).any(axis=1)) + 1
        for start, end in zip([0, *turns], [*turns, len(where)]):
            place, kind = tuple(where[start][:2]) if start < end else here, where[start][2] if start < end else 0
            if place != here:
                here, pending, block = place, [], None
            for at in range(start, end, end - start if kind == 0 else TOGETHER):
                some = slice(at, end if kind == 0 else min(at + TOGETHER, end))
                piece = {name: column.slice(some.start, some.stop - some.start) for name, column in columns.items()}
                flat, sizes = _lists(piece["vec"])
                matrix = padded(flat, sizes, int(sizes.max(initial=0)))
                keys, labels = piece["key"].to_numpy(), piece["label"].to_numpy()
                if kind == 0:
                    pending.append((keys, labels, matrix))
                    continue
                if block is None and pending:
                    width = max(rows.shape[1] for _, _, rows in pending)
                    block = Block(
                        np.concatenate([one[0] for one in pending]), np.concatenate([one[1] for one in pending]),
                        np.concatenate([np.pad(rows, ((0, 0), (0, width - rows.shape[1]))) for _, _, rows in pending]),
                    )
                    pending = []
                if block is None:
                    continue
                flat_tops, counts = _lists(piece["tops"])
                tops = np.split(flat_tops.astype(np.int64), np.cumsum(counts)[:-1])
                lows = [np.array([-FAR if ratio is None else -((-ratio[0] * one) // ratio[1]) for one in top.tolist()], np.int64) for top in tops]
                # A negative positive score turns its window round: it holds nothing.
                real = [low <= top for low, top in zip(lows, tops)]
                tops, lows = [top[ok] for top, ok in zip(tops, real)], [low[ok] for low, ok in zip(lows, real)]
                found = [(int(keys[q]), *rest) for q, *rest in block.windows(matrix, labels, tops, lows, need, same)]
                if found:
                    yield found


def mine(
    df: DataFrame, is_anchor: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    scale: int = 256, positives: int = 5, negatives: int = 5, ratio: tuple[int, int] = (80, 100),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on ``vec_id``.  An anchor's positives are its first
    ``positives`` other rows of its label by score, then id; each gets the first
    ``negatives`` rows of other labels that score at most as much as the positive
    and at least ``ratio`` of it.
    """
    anchored = df.select(vec_id, vector, label, is_anchor.alias("_anchor"))
    flagged = vector_rows(anchored, vec_id, vector, label, scale)
    first = Window.partitionBy("label", "vec").orderBy("id")
    rows = staged(
        flagged.withColumn("_place", F.row_number().over(first)).where(F.col("_place") <= max(positives, negatives) + 1).drop("_place")
    )
    anchors = staged(
        vector_rows(anchored.where("_anchor"), vec_id, vector, label, scale).select("*", F.monotonically_increasing_id().alias("q"))
    )
    blocks = blocks_of(rows)

    # The anchor itself is among its closest rows, or behind as many copies with smaller ids.
    own = F.aggregate("vec", F.lit(0).cast("bigint"), lambda total, x: total + x * x)
    closest = searched(rows, anchors.withColumn("tops", F.array(F.lit(FAR))), blocks, positives + 1, True, None)
    by_score = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    ranked = closest.withColumn("_rank", F.row_number().over(by_score)).where(F.col("_rank") <= positives + 1)
    ranked = ranked.join(anchors.select("q", F.col("id").alias("anchor_id"), own.alias("_own")), "q")
    is_self = (F.col("id") == F.col("anchor_id")) & (F.col("score") == F.col("_own"))
    itself = F.coalesce(F.min(F.when(is_self, F.col("_rank"))).over(Window.partitionBy("q")), F.lit(positives + 1))
    chosen = staged(
        ranked.withColumn("_self", itself).where(F.col("_rank") != F.col("_self"))
        .select("q", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("top"))
    )

    tops = chosen.groupBy("q").agg(F.collect_set("top").alias("tops"))
    near = searched(rows, anchors.join(tops, "q"), blocks, negatives, False, ratio)
    in_window = Window.partitionBy("q", "top").orderBy(F.desc("score"), "id")
    hard = near.withColumn("rank", F.row_number().over(in_window)).where(F.col("rank") <= negatives)
    return chosen.join(hard, ["q", "top"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
        F.col("top").alias("positive_score"), F.col("score").alias("negative_score"),
    )
