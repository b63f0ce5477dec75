"""Document fingerprints from closed syncmers; DataFrame functions only.

A k-mer is a run of K words; it is an anchor if the smallest hash of the S-word
runs inside it stands at its first or last place.  Whether a k-mer is chosen
depends on its own words alone, so a passage has the same anchors wherever it
stands, and any stretch of 2K - S words holds at least one anchor.

Defined cases: a null text counts as empty.  A text of fewer than K words has one
anchor, the hash of all its words; one without words has none.  Texts without
anchors are alike (likeness 1) and unlike any other (0).  Repeated rows have
equal fingerprints; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabwright.llm.common import bound, words_of

K, S = 5, 2


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """Array of (place, hash): the closed syncmers of a text by the number of their first word.

    The ends win ties, so a run of one repeated word is anchored everywhere.
    """
    def inner_runs(hashes: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(hashes) - s)
        return F.transform(places, lambda at: F.xxhash64(*[F.get(hashes, at + step) for step in range(s)]))

    def chosen(runs: Column) -> Column:
        last = k - s
        middle = lambda at: F.least(*[F.get(runs, at + step) for step in range(1, last)])
        ends = lambda at: F.least(F.get(runs, at), F.get(runs, at + last))
        places = F.filter(F.sequence(F.lit(0), F.size(runs) - last - 1), lambda at: ends(at) <= middle(at))
        covering = range(0, last + 1, s) if last % s == 0 else (*range(0, last, s), last)
        return F.transform(places, lambda at: F.struct(
            at.alias("place"), F.xxhash64(*[F.get(runs, at + step) for step in covering]).alias("hash")))

    def of_words(words: Column) -> Column:
        few = F.when(F.size(words) == 0, F.slice(F.array(F.struct(F.lit(0).alias("place"), F.lit(0).cast("long").alias("hash"))), 1, 0)).otherwise(
            F.array(F.struct(F.lit(0).alias("place"), F.xxhash64(words).alias("hash"))))
        hashes = F.transform(words, lambda word: F.xxhash64(word))
        return F.when(F.size(words) < k, few).otherwise(bound(hashes, lambda all_words: bound(inner_runs(all_words), chosen)))

    return bound(words_of(text), of_words)


def anchor_hashes(found: Column) -> Column:
    return F.array_distinct(F.transform(found, lambda anchor: anchor["hash"]))


def fingerprint(found: Column) -> Column:
    """16 hexadecimal digits over the places and hashes of all anchors, in order."""
    return F.lower(F.lpad(F.hex(F.xxhash64(found)), 16, "0"))


def likeness(first: Column, second: Column) -> Column:
    """Dice share of two sets of anchor hashes: 0 (none in common) to 1 (the same)."""
    both = F.size(F.array_intersect(first, second))
    total = F.size(first) + F.size(second)
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * both / total)


def shared_runs(first: Column, second: Column) -> Column:
    """Positional matches: array of (place, shift) for anchors of ``first`` whose hash ``second`` has.

    ``shift`` is the place of the first equal anchor in ``second`` minus the
    place in ``first``; equal shifts in a row are a passage that both texts hold.
    """
    def against(other: Column) -> Column:
        by_hash = F.map_from_entries(F.transform(
            F.array_distinct(F.transform(other, lambda anchor: anchor["hash"])),
            lambda value: F.struct(value, F.array_min(F.transform(
                F.filter(other, lambda anchor: anchor["hash"] == value), lambda anchor: anchor["place"])))))
        return bound(by_hash, lambda known: F.filter(
            F.transform(first, lambda anchor: F.struct(
                anchor["place"].alias("place"), (F.try_element_at(known, anchor["hash"]) - anchor["place"]).alias("shift"))),
            lambda match: match["shift"].isNotNull()))

    return bound(second, against)


def with_neighbour(docs: DataFrame, key: str, values: list[str], runs: int) -> DataFrame:
    """Add ``next_<value>``: the values of the row with the next smaller key, after the smallest the largest.

    Rows are cut into ``runs`` key ranges at quantiles that are computed first,
    so the range of a row depends on its key alone.  Each range gets a copy of
    the first row of the range below it, which makes the neighbour of every row
    part of its own range; there is one such copy per range.
    """
    bounds = sorted(set(docs.approxQuantile(key, [step / runs for step in range(1, runs)], 1 / (4 * runs)))) if runs > 1 else []
    cuts = F.array(*[F.lit(int(value)) for value in bounds]) if bounds else F.array().cast("array<bigint>")
    rows = docs.withColumn("_run", F.size(F.filter(cuts, lambda cut: cut <= F.col(key)))).withColumn("_guest", F.lit(0))
    tops = [(row["_run"], row["top"]) for row in rows.where(F.col(key).isNotNull()).groupBy("_run").agg(F.max(key).alias("top")).collect()]
    if tops:
        tops.sort()
        # The run below gives its largest key to the run above; the uppermost gives its own to the lowest.
        above = {top: tops[(place + 1) % len(tops)][0] for place, (_, top) in enumerate(tops)}
        moved = F.create_map(*[F.lit(item) for pair in above.items() for item in pair])
        guests = (
            docs.where(F.col(key).isin(list(above)))
            .withColumn("_run", F.element_at(moved, F.col(key)).cast("int")).withColumn("_guest", F.lit(1))
        )
        rows = rows.unionByName(guests)
    order = Window.partitionBy("_run").orderBy("_guest", F.col(key).desc_nulls_last(), *[F.col(name) for name in values])
    for name in values:
        rows = rows.withColumn(f"next_{name}", F.lead(name).over(order))
    return rows.where("_guest = 0").drop("_run", "_guest")


def edited_neighbours(docs: DataFrame, key: str = "doc_id", text: str = "text", runs: int = 200) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has its last half of code points replaced by the first as
    many of the next document (descending key, after the last the first).
    Returns key, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next.
    """
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    half = F.floor(F.length("text") / 2).cast("int")
    pairs = with_neighbour(rows, "_key", ["text"], runs).select(
        "_key", "text", "next_text",
        F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half)).alias("edited"),
    )
    found = {name: anchors(F.col(column)) for name, column in (("own", "text"), ("other", "edited"), ("next", "next_text"))}
    marked = pairs.select(
        "_key", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        # One row in, one row out: the anchors are computed once, whatever asks for them above.
        F.inline(F.array(F.struct(*[column.alias(name) for name, column in found.items()]))),
    )
    near = lambda other: bound(anchor_hashes(F.col("own")), lambda a: bound(anchor_hashes(F.col(other)), lambda b: likeness(a, b)))
    return marked.select(
        F.col("_key").alias(key), "n_chars", "edited_sha256",
        fingerprint(F.col("own")).alias("fingerprint"), fingerprint(F.col("other")).alias("edited_fingerprint"),
        near("other").alias("near_edited"), near("next").alias("near_next"),
    )
