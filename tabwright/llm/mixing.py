"""Mixing sources to target weights along a time-varying curriculum; DataFrame functions only.

Every source has a weight that changes linearly over training time: it starts at
``weight * (1 - slope)`` and ends at ``weight * (1 + slope)``.  The integral of
the schedule is the source's share of the words; inverting that integral at a
document's place in its source gives its training position between 0 and 1.

Defined cases: a null text has size 0 and is taken with no words; a null source
is a source of its own, ranked last; a null key sorts first in its source.  A
source without words has target 0.  Repeated rows are separate documents.  An
empty table gives an empty result.  Output columns replace input columns of the
same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabwright.llm.common import count_words, sheltered

WEIGHTS = (1, 2, 3)
SLOPES = (-0.5, 0.0, 0.5)
MOST_REPEATS = 3
# Hexadecimal digits of the shuffling hash that cut a source into runs: 16**3 runs.
RUN_DIGITS = 3


def _cycled(values: tuple, rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(value) for value in values]), (rank % len(values) + 1).cast("int"))


def target_words(per_source: DataFrame, weights: tuple = WEIGHTS, slopes: tuple = SLOPES,
                 share: float = 1.0, most: int = MOST_REPEATS) -> DataFrame:
    """Words each source should give: ``share`` of all words dealt by weight.

    ``per_source`` holds (_tw_source, source, source_size), one row per source.
    No target passes ``most`` times the source's words; the excess goes to the
    others by weight.  With sources in rising order of capacity per weight, the
    words per unit of weight after the first k are full rise with k until no
    further source is full and fall afterwards, so their maximum is the level.
    """
    ranked = per_source.withColumn("_tw_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.select(
        "_tw_source", "source_size", "_tw_rank",
        _cycled(weights, F.col("_tw_rank")).alias("_tw_weight"), _cycled(slopes, F.col("_tw_rank")).alias("_tw_slope"),
        (F.col("source_size") * most).alias("_tw_most"),
    )
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("_tw_most") / F.col("_tw_weight"), "_tw_rank").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("_tw_most").over(before), F.lit(0))
    weight = F.sum("_tw_weight").over(everything) - F.coalesce(F.sum("_tw_weight").over(before), F.lit(0))
    level = ranked.withColumn("_tw_level", left.cast("double") / weight.cast("double"))
    level = level.withColumn("_tw_level", F.max("_tw_level").over(everything))
    return level.withColumn(
        "target", F.least(F.col("_tw_most").cast("double"), F.col("_tw_level") * F.col("_tw_weight"))
    ).select("_tw_source", "source_size", "target", "_tw_slope")


def training_position(part: Column, slope: Column) -> Column:
    """The time at which a source has given ``part`` (0 to 1) of its words: the inverse of (1-s)t + s t²."""
    first = 1 - slope
    curved = (F.sqrt(first * first + 4 * slope * part) - first) / (2 * slope)
    return F.when(slope == 0, part).otherwise(F.least(F.greatest(curved, F.lit(0.0)), F.lit(1.0)))


def _placed(docs: DataFrame, weights: tuple, slopes: tuple, share: float, most: int,
            key: str, text: str, source: str) -> tuple[DataFrame, dict[str, Column]]:
    """Sheltered rows with size, source_size, target, copies, and the part of the source up to their middle."""
    inner, given = sheltered(docs)
    rows = inner.select(
        "*",
        given[key].alias("_key"),
        F.md5(F.coalesce(given[key].cast("string"), F.lit(""))).alias("_hash"),
        given[source].alias("source"),
        # Null and the text "" are different sources; a join key must tell them apart without being null.
        F.when(given[source].isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), given[source].cast("string"))).alias("_tw_source"),
        count_words(F.coalesce(given[text], F.lit(""))).alias("size"),
    ).withColumn("_run", F.substring("_hash", 1, RUN_DIGITS))
    runs = rows.groupBy("_tw_source", "source", "_run").agg(F.sum("size").alias("_words"))
    targets = target_words(
        runs.groupBy("_tw_source", "source").agg(F.sum("_words").alias("source_size")), weights, slopes, share, most
    )
    earlier_runs = Window.partitionBy("_tw_source").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        runs.select("_tw_source", "_run", F.coalesce(F.sum("_words").over(earlier_runs), F.lit(0)).alias("_start"))
        .join(targets, "_tw_source")
    )
    earlier = (
        Window.partitionBy("_tw_source", "_run").orderBy("_hash", F.col("_key").asc_nulls_first(), "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        rows.withColumn("_before", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
        .join(starts, ["_tw_source", "_run"])
        .withColumn("_middle", F.col("_before") + F.col("_start") + F.col("size") / 2)
    )
    some = F.col("source_size") > 0
    whole = F.floor(F.col("target") / F.col("source_size"))
    rest = F.col("target") - whole * F.col("source_size")
    copies = F.when(some, whole + (F.col("_middle") < rest).cast("long")).otherwise(F.lit(0))
    return placed.withColumn("copies", F.least(copies, F.lit(most)).cast("long")), given


def _position(copy: Column) -> Column:
    """Training position of a document's pass number ``copy`` (from 0): that many whole passes come before it."""
    demand = F.when(F.col("target") > 0, (copy * F.col("source_size") + F.col("_middle")) / F.col("target"))
    return training_position(F.least(F.coalesce(demand, F.lit(1.0)), F.lit(1.0)), F.col("_tw_slope"))


OUTPUT = ("size", "source_size", "target", "copies", "taken", "position")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, slopes: tuple = SLOPES, share: float = 1.0,
        most: int = MOST_REPEATS, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Input rows with size, source_size, target, copies, taken and position (of the first copy), ranged by position.

    Within a source the documents stand in the order of a hash of their key.
    The whole source is taken ``floor(target / source_size)`` times, and once
    more up to the document in whose middle the rest of the target ends.

    A source is summed in runs of equal hash prefix, so a source with a third of
    all rows spreads over thousands of tasks; only one row per source and run
    passes the window over a source.
    """
    placed, given = _placed(docs, weights, slopes, share, most, key, text, source)
    return (
        placed.withColumn("taken", F.col("copies") * F.col("size"))
        .withColumn("position", _position(F.lit(0)))
        .orderBy("position", "_hash", F.col("_key").asc_nulls_first(), "size")
        .select(*[column for name, column in given.items() if name not in OUTPUT], *OUTPUT)
    )


def mixed_rows(docs: DataFrame, weights: tuple = WEIGHTS, slopes: tuple = SLOPES, share: float = 1.0,
               most: int = MOST_REPEATS, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The training order itself: every copy that the mix takes as a row with the input's columns, ranged by position."""
    placed, given = _placed(docs, weights, slopes, share, most, key, text, source)
    return (
        placed.where("copies > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("copies").cast("int") - 1)))
        .withColumn("_position", _position(F.col("_copy")))
        .orderBy("_position", "_hash", F.col("_key").asc_nulls_first(), "_copy", "size")
        .select(*given.values())
    )
