"""Quality rules with host verdicts; DataFrame functions only.

Each document is judged by rules on its own words and lines.  The failures are
counted per host (here the ``source`` column), a host's rate is shrunk towards
the rate of all hosts with an empirical beta prior, and hosts whose shrunk rate
is too high, by itself and beside the rate of all documents, lose all their
documents.

Defined cases: a null text has no words; a null host is a host of its own; an
empty table gives an empty result.  Repeated rows are judged alike.  Output
columns replace input columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import BLANK_CHARS, bound, sheltered, staged, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30          # per cent of the words
MOST_SYMBOLS = 10           # per cent of the words
MOST_DUP_LINES = 30         # per cent of the words
WORD_CHARS = (2, 15)        # mean code points per word
MOST_HOST_RATE = 0.5
# A rejected host also fails so many times as often as all documents do.
HOST_LIFT = 1.5
# The prior counts as this many documents at least and at most.
PRIOR_DOCS = (2.0, 1000.0)
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window of ``window`` words which the text holds twice or more.

    Windows are compared by 64-bit hashes within one text, built from pairs of
    hashes of half as many words.  Texts whose windows of half the length are
    all different stop there; the others sort (hash, place) pairs, keep the
    places with an equal neighbour and add up how far each such window reaches
    beyond the one before.  ``window`` is a power of two.
    """
    def same_hash(sorted_pairs: Column, place: Column, step: int) -> Column:
        return F.coalesce(F.get(sorted_pairs, place + step)["hash"] == F.get(sorted_pairs, place)["hash"], F.lit(False))

    def covered(places: Column) -> Column:
        reach = F.transform(places, lambda at, k: F.least(F.lit(window), F.coalesce(at - F.get(places, k - 1), F.lit(window))))
        return F.aggregate(reach, F.lit(0), lambda total, one: total + one)

    def repeated_places(pairs: Column) -> Column:
        twin = F.filter(pairs, lambda pair, k: same_hash(pairs, k, -1) | same_hash(pairs, k, 1))
        return F.sort_array(F.transform(twin, lambda pair: pair["place"]))

    def of_whole_windows(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda value, k: F.struct(value.alias("hash"), k.alias("place"))))
        return bound(pairs, lambda whole: bound(repeated_places(whole), covered))

    def doubled(hashes: Column, step: int) -> Column:
        left = F.slice(hashes, 1, F.greatest(F.size(hashes) - step, F.lit(0)))
        return F.zip_with(left, F.slice(hashes, step + 1, F.size(hashes)), lambda one, two: F.xxhash64(one, two))

    def grown(hashes: Column, step: int) -> Column:
        if 2 * step < window:
            return bound(doubled(hashes, step), lambda longer: grown(longer, 2 * step))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            bound(doubled(hashes, step), of_whole_windows))

    return F.when(F.size(words) <= window, F.lit(0)).otherwise(
        bound(F.transform(words, lambda word: F.xxhash64(word)), lambda hashes: grown(hashes, 1)))


def text_features(text: Column) -> dict[str, Column]:
    """The base counts of one text as long columns; pass a text without nulls."""
    def repeated_lines(lines: Column) -> Column:
        return F.size(lines) - F.size(F.array_distinct(lines))

    worded = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counts = bound(words_of(text), lambda words: F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        repeated_words(words).cast("long").alias("n_repeat_words"),
    ))
    return {
        "_counts": counts,
        "n_symbols": F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long"),
        "n_dup_lines": bound(worded, repeated_lines).cast("long"),
    }


def _judged(docs: DataFrame, text: str, host: str, carry: list[str]) -> tuple[DataFrame, dict[str, Column]]:
    """The carried columns, sheltered, with the base counts, ``base_failed`` and ``_failed`` (any rule)."""
    inner, given = sheltered(docs)
    features = text_features(F.coalesce(given[text], F.lit("")))
    # A generator of one row: what stands above does not evaluate the counts again.
    counted = inner.select(
        *[F.col(f"_in{docs.columns.index(name)}") for name in carry], given[host].alias("_host"),
        F.inline(F.array(F.struct(*[column.alias(name) for name, column in features.items()]))),
    ).select("*", "_counts.*").drop("_counts")
    words = F.col("n_words")
    base = (words < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * words)
    shape = (
        (F.col("word_chars") < WORD_CHARS[0] * words) | (F.col("word_chars") > WORD_CHARS[1] * words)
        | (100 * F.col("n_symbols") > MOST_SYMBOLS * words) | (100 * F.col("n_dup_lines") > MOST_DUP_LINES * words)
    )
    return counted.withColumn("base_failed", base).withColumn("_failed", base | shape), given


def host_rates(hosts: DataFrame) -> DataFrame:
    """Per host (_host, docs, failed): the failure rate shrunk with a beta prior fitted to all hosts.

    Prior mean: the rate of all documents.  Prior strength by moments: the
    variance between hosts beyond what drawing ``docs`` documents explains.
    """
    total = hosts.agg(
        F.sum("failed").alias("failed"), F.sum("docs").alias("docs"),
        F.var_pop(F.col("failed") / F.col("docs")).alias("spread"), F.avg(1 / F.col("docs")).alias("noise"),
    ).first()
    mean = (total["failed"] or 0) / (total["docs"] or 1)
    between = (total["spread"] or 0.0) - mean * (1 - mean) * (total["noise"] or 0.0)
    strength = PRIOR_DOCS[1] if between <= 0 else mean * (1 - mean) / between - 1
    strength = min(max(strength, PRIOR_DOCS[0]), PRIOR_DOCS[1])
    return hosts.select(
        F.col("_host").alias("_known"),
        ((F.lit(mean * strength) + F.col("failed")) / (F.lit(strength) + F.col("docs"))).alias("host_rate"),
        F.lit(HOST_LIFT * mean).alias("_lifted"),
    )


OUTPUT = (*FEATURES, "base_failed", "host_rate", "kept")


def judge(docs: DataFrame, text: str = "text", host: str = "source", most_host_rate: float = MOST_HOST_RATE,
          carry: list[str] | None = None) -> DataFrame:
    """Input rows with the base counts, ``base_failed``, ``host_rate`` and ``kept``.

    ``carry`` names the input columns to return (all but the text by default).
    The judged rows are written once, so the counts are made once.  The counts
    of a host are summed in each task before the shuffle, and the join splits a
    hot host if the table of hosts is not small enough to be broadcast.
    """
    carry = [name for name in docs.columns if name != text] if carry is None else carry
    rows, given = _judged(docs, text, host, carry)
    rows = staged(rows)
    hosts = staged(rows.groupBy("_host").agg(F.count("*").alias("docs"), F.sum(F.col("_failed").cast("long")).alias("failed")))
    good_host = F.col("host_rate") <= F.greatest(F.lit(most_host_rate), F.col("_lifted"))
    return (
        rows.join(host_rates(hosts), F.col("_host").eqNullSafe(F.col("_known")))
        .withColumn("kept", ~F.col("base_failed") & good_host)
        .select(*[given[name] for name in carry if name not in OUTPUT], *OUTPUT)
    )


def kept_rows(docs: DataFrame, text: str = "text", host: str = "source", most_host_rate: float = MOST_HOST_RATE) -> DataFrame:
    """The documents that the rules and their host's verdict keep, with the input's columns."""
    inner, given = sheltered(docs)
    inside = {name: f"_in{place}" for place, name in enumerate(docs.columns)}
    kept = judge(inner, inside[text], inside[host], most_host_rate, carry=inner.columns).where("kept")
    return kept.select(*given.values())
