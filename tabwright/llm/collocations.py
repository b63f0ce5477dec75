"""Phrase collocations by Toivonen's mining: a sample proposes, full passes count exactly until nothing is left open.

A sample of the documents proposes the phrases that are frequent in it under a
lowered bound.  One pass over all documents counts them together with their
negative border: every phrase that is no proposal itself but whose longest parts
(its first and its last k - 1 words) are, and every single word.  A phrase of the
border that turns out to be frequent is a failure of the sample: its extensions
were not counted.  Failures become proposals, and an expansion pass counts what
they add: new phrases are followed to their full length there, so it is closed.
(A part is at least as frequent as its phrase: if both parts of a frequent phrase
were counted in the first pass, they are proposals now; if one is new, it is
followed.  Either way the phrase is counted.)

These passes shuffle hashes of phrases and numbers only.  Two phrases of one hash
can only look more frequent than they are, so a last pass counts what looks
frequent by its spelling, over all documents, and decides.

Tasks ask a Bloom filter whether a phrase is proposed.  Its size is bounded
(``MOST_BITS``); a wrong yes only counts a phrase in vain.

Defined cases: a null text counts as empty, a null language is ``und``; an empty
or blank text has no words.  Repeated rows count each time.  An empty table gives
an empty result.  Only the named columns are read, so others cannot clash.
Phrases never cross a piece, so long texts are counted in parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwright.llm.common import mapped, staged
from tabwright.llm.phrase_counts import LENGTH_BITS, LENGTH_MASK, Filter, Words, chunks, tagged

MOST_WORDS = 5
# Share of the documents in the sample, in thousandths.
SAMPLE = 100
# The sample's bound lies so many standard deviations below the expected count of a phrase that is just frequent.
MARGIN = 2.0
# Rows that are held as Python strings at a time.
ROWS = 256
# Languages whose sizes are broadcast (a few MB); more are joined by a shuffle.
FEW_LANGUAGES = 50_000
# Bits of the filter for each proposal, and the largest filter (16 MB) and the smallest.
BITS_EACH, MOST_BITS, LEAST_BITS = 16, 1 << 27, 1 << 16


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    few = (batch.slice(start, ROWS) for batch in batches for start in range(0, batch.num_rows, ROWS))
    rows = (pair for some in few for pair in zip(some.column(0).to_pylist(), some.column(1).to_pylist()))
    for texts in chunks(rows):
        yield Words(texts)


def counted(docs: DataFrame, most: int, proposed=None, before=None, depth: int | None = None, least: int = 1) -> DataFrame:
    """(hash, n) of the phrases that ``Words.phrases`` counts, over all rows of docs(lang, text).

    ``proposed`` and ``before`` are broadcast filters; lengths below ``least`` are
    walked through, not returned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, past = (Filter(one.value) if one is not None else None for one in (proposed, before))
        for chunk in _chunks(batches):
            for k, _, _, counts, hashes in chunk.phrases(most, now, past, depth):
                if k >= least:
                    columns = [pa.array(tagged(hashes, k).view(np.int64)), pa.array(counts.astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, ["hash", "n"])

    return mapped(docs.select("lang", "text"), run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


def spelled_out(docs: DataFrame, most: int, wanted) -> DataFrame:
    """(lang, phrase, n) of the phrases that the filter has; the empty phrase stands for all words of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, names = Filter(wanted.value), ["lang", "phrase", "n"]
        for chunk in _chunks(batches):
            langs = pa.array(list(chunk.langs), pa.string())
            _, totals = chunk.totals()
            yield pa.RecordBatch.from_arrays([langs, pa.array([""] * len(langs), pa.string()), pa.array(totals, pa.int64())], names)
            for _, lang_of, words, counts, hashes in chunk.phrases(most, held):
                some = held.has(hashes)
                if some.any():
                    columns = [langs.take(pa.array(lang_of[some])), chunk.spelled(words[some]), pa.array(counts[some].astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return mapped(docs.select("lang", "text"), run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def filter_words(hashes: DataFrame, bits: int) -> np.ndarray:
    """The filter of a ``hash`` column as 64-bit words; ``bits`` bound what reaches the driver."""
    # As Filter.places, without leaving 64 bits.
    step = F.shiftrightunsigned("hash", 33).bitwiseOR(F.lit(1))
    low = F.shiftright("hash", LENGTH_BITS).bitwiseAND(F.lit(bits - 1))
    places = F.array(*[(low + F.lit(probe) * step).bitwiseAND(F.lit(bits - 1)) for probe in range(Filter.PROBES)])
    placed = hashes.select(F.explode(places).alias("place"))
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    packed = placed.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[packed.column("word").to_numpy()] = packed.column("bits").to_numpy().view(np.uint64)
    return words


def unproposed(phrases: DataFrame, proposed) -> DataFrame:
    """Rows whose hash the filter does not have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Filter(proposed.value)
        for batch in batches:
            hashes = batch.column("hash").to_numpy().view(np.uint64)
            yield batch.filter(pa.array(~held.has(hashes)))

    return mapped(phrases, run, phrases.schema)


def frequent_phrases(
    df: DataFrame, least: int = 100, most: int = MOST_WORDS, text: str = "text", lang: str = "lang",
    sample: int = SAMPLE, key: str | None = None,
) -> DataFrame:
    """(lang, k, phrase, n): all phrases of 1 to ``most`` words with ``least`` occurrences, and k = 0 for all words.

    ``key`` spreads the sample over copies of a text; results do not depend on it.
    """
    spark = df.sparkSession
    dealt = F.pmod(F.xxhash64(*[F.col(name) for name in (key, text) if name]), F.lit(1000))
    docs = df.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"), dealt.alias("_dealt"))
    some = docs.where(F.col("_dealt") < sample)
    expected = least * sample / 1000
    bound = max(2, int(expected - MARGIN * expected**0.5))

    share = lambda words: spark.sparkContext.broadcast(words)
    size = lambda rows: min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * rows.count()).bit_length()))

    # The sample: words and pairs first, then longer phrases whose pairs are all frequent in it.
    short = staged(counted(some, min(2, most)).where(F.col("n") >= bound).select("hash"))
    pairs = share(filter_words(short, size(short)))
    longer = counted(some, most, proposed=pairs, depth=2, least=3).where(F.col("n") >= bound).select("hash")
    guesses = staged(short.unionByName(longer))
    bits = size(guesses)
    words = filter_words(guesses, bits)

    proposed = share(words)
    found = staged(counted(docs, most, proposed).where(F.col("n") >= least).select("hash"))
    shorter = F.col("hash").bitwiseAND(F.lit(LENGTH_MASK)) < most
    failed = staged(unproposed(found.where(shorter), proposed))
    if not failed.isEmpty():
        more = share(words | filter_words(failed, bits))
        found = staged(found.unionByName(counted(docs, most, more, before=proposed, least=2).where(F.col("n") >= least).select("hash")))
    exact = spelled_out(docs, most, share(filter_words(found, size(found))))
    length = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    return staged(exact.where((F.col("n") >= least) | (F.col("phrase") == "")).withColumn("k", length)).select("lang", "k", "phrase", "n")


def cut_scores(phrases: DataFrame, factor: int = 1000) -> DataFrame:
    """(lang, phrase, k, a, l, r, n, score) of each phrase of two words or more at its weakest cut.

    Products stay exact in 38 digits: counts of up to 17 digits fit.
    """
    sizes = phrases.where(F.col("k") == 0).select("lang", F.col("n").alias("total"))
    counts = phrases.where(F.col("k") > 0)
    words = F.split("phrase", " ")
    cuts = (
        counts.where(F.col("k") > 1)
        .select("lang", "phrase", "k", F.col("n").alias("a"), words.alias("_words"), F.explode(F.expr("sequence(1, k - 1)")).alias("cut"))
        .select(
            "lang", "phrase", "k", "a", "cut",
            F.array_join(F.expr("slice(_words, 1, cut)"), " ").alias("_first"), F.array_join(F.expr("slice(_words, cut + 1, k)"), " ").alias("_rest"),
        )
    )
    part = lambda name, count: counts.select("lang", F.col("phrase").alias(name), F.col("n").alias(count))
    if sizes.count() <= FEW_LANGUAGES:
        sizes = F.broadcast(sizes)
    whole = cuts.join(part("_first", "l"), ["lang", "_first"]).join(part("_rest", "r"), ["lang", "_rest"]).join(sizes, "lang")
    score = F.expr(f"(cast({factor} as decimal(4,0)) * (cast(a as decimal(17,0)) * cast(total as decimal(17,0)))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    scored = whole.withColumn("score", score)
    weakest = F.min_by(F.struct("l", "r", "score"), F.struct("score", "cut")).alias("_cut")
    return scored.groupBy("lang", "phrase", "k", "a", F.col("total").alias("n")).agg(weakest).select(
        "lang", "phrase", "k", "a", "_cut.l", "_cut.r", "n", "_cut.score"
    )


def maximal(scored: DataFrame) -> DataFrame:
    """Without phrases that stand in a longer one as often as anywhere.

    Counts fall from a phrase to any longer one, so a longer one of equal count
    exists if and only if one that is longer by one word does.
    """
    longer = scored.where(F.col("k") > 2)
    shorter = [F.array_join(F.expr(part), " ").alias("phrase") for part in ("slice(split(phrase, ' '), 1, k - 1)", "slice(split(phrase, ' '), 2, k)")]
    inside = longer.select("lang", shorter[0], "a").unionByName(longer.select("lang", shorter[1], "a")).distinct()
    return scored.join(inside, ["lang", "phrase", "a"], "left_anti")


def collocations(
    df: DataFrame, least: int = 100, first: int = 2000, most: int = MOST_WORDS, text: str = "text", lang: str = "lang",
    key: str | None = None, sample: int = SAMPLE,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first phrases by score, count and spelling."""
    phrases = frequent_phrases(df, least, most, text, lang, sample, key)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = maximal(staged(cut_scores(phrases))).withColumn("rank", F.row_number().over(order).cast("long"))
    return ranked.where(F.col("rank") <= first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
