"""Scores of whole texts by a causal self-attention model, beside a word-frequency base.

Texts are read twice: for the word counts of all training documents, and for
their base and subword ids, which are staged as 16-bit numbers.  All else is
done on the ids.  The attention model (``attention``) trains on all subword ids
of all training documents, each a target once: a hash of its text puts a
document into one of ROUNDS rounds.  In each round every partition trains from
the same weights, on windows as they are read, and the weighted mean goes into
the next.  Overlapping windows of a text's ids score each id once.

The base needs the count of every word.  Short words that make up one in
BROADCAST_WORDS tokens or more, of which there cannot be more than that many, go to
the tasks; all other words are joined by the word, so no word with many rows
passes the shuffle.

Words are runs of anything but the six ASCII blanks, with A-Z in lower case; one
end follows each text and counts as a token.  A row trains unless crc32 of its id
as text leaves HELD_FOLD.  Defined cases: a null or empty text is its end; a null
id counts as empty text; repeated rows count and score one by one; without
training rows all counts are 0 and the model keeps its first weights.  An empty
table gives an empty result.  Output columns replace input columns of the same name.
"""

from __future__ import annotations

import base64
import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm import attention
from tabwright.llm.common import mapped, sheltered, staged
from tabwright.llm.word_arrays import joined, lower_words, slices

TOKENIZER = public_tokenizers.path("byte_bpe_50k.tiktoken")
FOLDS, HELD_FOLD = 5, 1
END_ID = 50256
IDS = 50257
BROADCAST_WORDS, BROADCAST_BYTES = 1_000_000, 32
# Different words that a task holds before it hands their counts on.
HELD_WORDS = 500_000
# Words whose ids a Python worker remembers, up to a length.
KNOWN_WORDS, KNOWN_BYTES = 500_000, 48
# Texts that are scored and handed on together.
TEXTS = 1000
ROUNDS = 2
# Windows that a task holds and shuffles before it trains on them.
HELD_WINDOWS = 8192


def held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_FOLD


def words_in(text: str | None) -> list[bytes]:
    """Words in lower case; bytes, whose lower() and split() know A-Z and the six blanks only."""
    return (text or "").encode().lower().split()


class WordIds(dict):
    """Subword ids (little-endian, 32 bits) of words, each with a space before it."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(piece): int(number) for piece, number in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __missing__(self, word: bytes) -> bytes:
        ids = np.array(self.encode(" " + word.decode()), "<u4").tobytes()
        if len(word) <= KNOWN_BYTES:
            if len(self) >= KNOWN_WORDS:
                self.clear()
            self[word] = ids
        return ids


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One table per Python worker and file."""
    return WordIds(path)


def ids_in(words: list[bytes], tokenizer: str) -> np.ndarray:
    """Subword ids of the words and the end."""
    return np.frombuffer(b"".join([*map(word_ids(tokenizer).__getitem__, words), END_ID.to_bytes(4, "little")]), "<u4").astype(np.int32)


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all rows of the one column; counted in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(held, pa.binary()).cast(pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for part in slices(batch, 0):
                numbers, words, _ = lower_words(part.column(0))
                held.update(dict(zip(words, np.bincount(numbers, minlength=len(words)).tolist())))
                if len(held) >= HELD_WORDS:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return mapped(texts, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def id_counts(ids: DataFrame) -> np.ndarray:
    """Count of each subword id in the one column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(IDS, np.int64)
        for batch in batches:
            for own in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(own, "<u2"), minlength=IDS)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["id", "n"])

    total = np.zeros(IDS, np.int64)
    for row in mapped(ids, run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        total[row["id"]] = row["n"]
    return total


def ids_of_each(column: pa.Array, tokenizer: str) -> Iterator[np.ndarray]:
    """Subword ids of texts, or of ids staged as 16-bit numbers."""
    for own in column.to_pylist():
        yield np.frombuffer(own, "<u2").astype(np.int32) if isinstance(own, bytes) else ids_in(words_in(own), tokenizer)


def training_windows(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[np.ndarray]:
    """Windows over all ids of the texts in the one column, shuffled HELD_WINDOWS at a time."""
    pick = np.random.default_rng(11)
    held, size = [], 0
    for batch in batches:
        for ids in ids_of_each(batch.column(0), tokenizer):
            found = attention.training_windows(ids, END_ID)
            while size + len(found) >= HELD_WINDOWS:
                cut = HELD_WINDOWS - size
                yield pick.permutation(np.concatenate([*held, found[:cut]]))
                found, held, size = found[cut:], [], 0
            held.append(found)
            size += len(found)
    if size:
        yield pick.permutation(np.concatenate(held))


def trained(rows: DataFrame, vocabulary: attention.Vocabulary, tokenizer: str, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """Rounds of training in every partition on their share of the rows (ids, round), and averaging by windows; the driver sees one mean per weight."""
    weights = attention.fresh(vocabulary)
    names, shapes = list(weights), {name: value.shape for name, value in weights.items()}
    ids, own_round = rows.columns
    for number in range(rounds):
        start = weights

        def run(batches: Iterator[pa.RecordBatch], start: dict = start) -> Iterator[pa.RecordBatch]:
            trainer, seen = attention.Trainer(start, vocabulary), 0
            for windows in training_windows(batches, tokenizer):
                seen += len(windows)
                trainer.feed(windows)
            if seen:
                flat = np.concatenate([trainer.weights[name].ravel() for name in names]).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(flat))), pa.array(flat * seen), pa.array(np.full(len(flat), seen))], ["place", "sum", "n"])

        share = rows.where(F.col(own_round) == number).select(ids)
        means = (
            mapped(share, run, "place long, sum double, n long").groupBy("place")
            .agg((F.sum("sum") / F.sum("n")).alias("mean")).collect()
        )
        if not means:
            continue
        flat = np.zeros(sum(int(np.prod(shape)) for shape in shapes.values()))
        for row in means:
            flat[row["place"]] = row["mean"]
        pieces = np.split(flat, np.cumsum([int(np.prod(shape)) for shape in shapes.values()])[:-1])
        weights = {name: piece.reshape(shapes[name]).astype(np.float32) for name, piece in zip(names, pieces)}
    return weights


RARE = T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.IntegerType())]))
OUTPUT = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def lm_scores(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """Input rows without their text, with held_out, n_tokens, n_known, train_tokens, base_score and score (log10)."""
    inner, given = sheltered(docs)
    place_of = {name: f"_in{number}" for number, name in enumerate(docs.columns)}
    keep = [place_of[name] for name in docs.columns if name not in (text, *OUTPUT)]
    training = inner.where(~held_out(F.col(place_of[key]))).select(place_of[text])
    counts = staged(word_counts(training))
    ends = training.count()
    size = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("words")).first()
    tokens, different = size["n"] + ends, size["words"] + (ends > 0)
    total = tokens + 0.5 * (different + 1)
    log_of = lambda count: math.log10((count + 0.5) / total)
    frequent = {row["word"].encode(): log_of(row["n"]) for row in
                counts.where((F.octet_length("word") <= BROADCAST_BYTES) & (F.col("n") * BROADCAST_WORDS >= tokens)).collect()}
    end_log = log_of(ends)

    def encoded_part(batch: pa.RecordBatch) -> pa.RecordBatch:
        numbers, words, sizes = lower_words(batch.column(place_of[text]))
        last = np.cumsum(sizes)
        first = last - sizes
        logs = np.array([frequent.get(word, np.nan) for word in words], np.float64).take(numbers)
        rare = np.isnan(logs)
        # Different rare words of each text, with how often it has them.
        pairs, rare_counts = np.unique(np.repeat(np.arange(len(sizes)), sizes)[rare] * (len(words) + 1) + numbers[rare], return_counts=True)
        rare_texts, rare_words = np.divmod(pairs, len(words) + 1)
        rare_ends = np.searchsorted(rare_texts, np.arange(len(sizes) + 1))
        known = sizes - np.bincount(np.repeat(np.arange(len(sizes)), sizes)[rare], minlength=len(sizes)) + (ends > 0)
        logs[rare] = 0.0
        all_logs = logs.tolist()
        base = [math.fsum(all_logs[begin:end]) + end_log for begin, end in zip(first.tolist(), last.tolist())]
        parts = [*map(word_ids(tokenizer).__getitem__, words), END_ID.to_bytes(4, "little")]
        with_ends = np.insert(numbers, last, len(words))
        ids, own = joined(parts, with_ends, 4)
        id_ends = np.concatenate(([0], np.cumsum(own)[last + np.arange(len(last))])) * 2
        ids = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(id_ends), pa.py_buffer(ids.astype("<u2"))])
        rare = pa.ListArray.from_arrays(pa.array(rare_ends, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(words, pa.binary()).cast(pa.string()).take(pa.array(rare_words)), pa.array(rare_counts, pa.int32())], ["word", "n"]))
        return pa.RecordBatch.from_arrays(
            [*[batch.column(name) for name in (*keep, "_held", "_round")], pa.array(sizes + 1, pa.int64()), pa.array(known, pa.int64()),
             pa.array(base, pa.float64()), rare, ids.cast(pa.binary())],
            [*keep, "_held", "_round", "_tokens", "_known", "_base", "_rare", "_ids"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from map(encoded_part, slices(batch, place_of[text]))

    rows = inner.select(
        *keep, place_of[text], held_out(F.col(place_of[key])).alias("_held"),
        F.pmod(F.xxhash64(F.coalesce(place_of[text], F.lit(""))), F.lit(ROUNDS)).cast("int").alias("_round"))
    schema = rows.select(*keep, "_held", "_round").schema.add("_tokens", "long").add("_known", "long").add("_base", "double")
    encoded = staged(mapped(rows, encode, schema.add("_rare", RARE).add("_ids", "binary")).withColumn("_row", F.monotonically_increasing_id()))
    training_ids = encoded.where("not _held")
    vocabulary = attention.Vocabulary.from_counts(id_counts(training_ids.select("_ids")))
    weights = trained(training_ids.select("_ids", "_round"), vocabulary, tokenizer)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = attention.Scorer(weights)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                ids = [np.frombuffer(own, "<u2") for own in part.column("_ids").to_pylist()]
                lengths = np.array([len(own) for own in ids], np.int64)
                scores = attention.score_texts(scorer, vocabulary, np.concatenate(ids).astype(np.int32), lengths, END_ID)
                names = [name for name in part.schema.names if name != "_ids"]
                yield pa.RecordBatch.from_arrays([*map(part.column, names), pa.array(scores)], [*names, "_score"])

    unscored = encoded.drop("_rare", "_round")
    scored = staged(mapped(unscored, score, unscored.drop("_ids").schema.add("_score", "double")))
    met = encoded.select("_row", F.inline("_rare")).join(counts.withColumnRenamed("n", "count"), "word", "left")
    count = F.coalesce("count", F.lit(0))
    others = met.groupBy("_row").agg(
        F.sum(F.col("n") * F.log10((count + 0.5) / F.lit(total))).alias("_more"),
        F.sum(F.when(count > 0, F.col("n")).otherwise(0)).alias("_also"),
    )
    return scored.join(others, "_row", "left").select(
        *[given[name] for name in docs.columns if name not in (text, *OUTPUT)],
        F.col("_held").alias("held_out"), F.col("_tokens").alias("n_tokens"),
        (F.col("_known") + F.coalesce("_also", F.lit(0))).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("_base") + F.coalesce("_more", F.lit(0.0))).alias("base_score"), F.col("_score").alias("score"),
    )
