"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Training takes a bounded sample of labelled rows (EXAMPLES per label, those with
the smallest hash of their id).  Every term of the sample is indexed; document
frequencies are counted over all documents.  A term's weight is its TF-IDF times
its relevance sqrt(1 + chi2), where chi2 says how far the term's presence depends
on the label in the sample: 1 for the bulk of the terms, more for those that tell
labels apart.  (The README gives the figures of plain TF-IDF.)

The examples' vectors form an inverted index whose posting lists are cut into
blocks of similar examples, each with its largest weight.  For a document the
block maxima bound the cosine of every example in a block; blocks are scored in
falling order of that bound until it drops below the k-th cosine found, so the
nearest examples are exact.  Their votes weigh by distance, and by how many
labelled rows an example stands for.  An isotonic fit turns a vote into a
probability; it sees votes of examples that had no part in the relevances and the
index they are held against (CALIBRATION_FOLDS folds).

Only the text is an input of a score.  Defined cases: a null or empty text, and
any text without a term of the sample, has no neighbour and gets the share of toxic
rows among such examples.  Without examples of both labels every score is the
share of toxic rows (0 without any).  Rows with equal texts get equal scores.  If
an id has several labels it is toxic if one says so; a null label is none.
Output columns replace input columns of the same name.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm.common import mapped, sheltered, staged

EXAMPLES = 2000
NEIGHBOURS = 20
CALIBRATION_FOLDS = 5
BLOCK = 64
DENSE = 8
THRESHOLD = 0.7
FOLDS, HELD_FOLD = 3, 1
WORD = re.compile(r"[^\W\d_]+")


def held_out(key: Column) -> Column:
    """Rows whose crc32 of the id as text leaves HELD_FOLD; a null id counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_FOLD


def terms_of(text: str | None) -> Counter:
    return Counter(WORD.findall((text or "").lower()))


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    ends = np.cumsum(sizes)
    numbers = np.repeat(starts - (ends - sizes), sizes)
    numbers += np.arange(len(numbers))
    return numbers


@dataclass
class BlockMaxIndex:
    """Inverted index over unit vectors, with block maxima.

    Postings stand term by term and by example within a term.  An entry is a
    term's part in one block: where its postings begin, and their largest weight.
    Lists of frequent terms are kept as rows over all examples and summed up first,
    exactly; the maxima bound what the other terms can add to that.
    """

    terms: dict[str, int]
    idf: np.ndarray             # weight of each term before its frequency in the text counts
    labels: np.ndarray
    stands_for: np.ndarray      # labelled rows per example
    ids: list
    places: np.ndarray          # example of each posting
    weights: np.ndarray
    first_entry: np.ndarray     # of each term, and the end
    entry_start: np.ndarray     # first posting of each entry, and the end
    entry_block: np.ndarray
    entry_top: np.ndarray
    row_of: np.ndarray          # of each term that one example in DENSE or more holds: its row, else -1
    rows: np.ndarray            # these terms' weights in every example

    @classmethod
    def build(cls, terms: list[str] | dict[str, int], idf: np.ndarray, rows: list[tuple[object, int, dict[int, int]]],
              stands_for: tuple[float, float] = (1.0, 1.0)) -> BlockMaxIndex:
        """Rows are (id, label, count by term number)."""
        vectors = [unit_vector(counts, idf) for _, _, counts in rows]
        numbers = np.concatenate([np.zeros(0, np.int64), *[own for own, _ in vectors]])
        places = np.repeat(np.arange(len(rows)), [len(own) for own, _ in vectors])
        weights = np.concatenate([np.zeros(0), *[own for _, own in vectors]])
        order = np.argsort(numbers, kind="stable")
        numbers, places, weights = numbers[order], places[order], weights[order]
        blocks = places // BLOCK
        fresh = np.flatnonzero(np.concatenate((np.ones(min(len(numbers), 1), bool), (np.diff(numbers) != 0) | (np.diff(blocks) != 0))))
        tops = np.maximum.reduceat(weights, fresh) if len(fresh) else np.zeros(0)
        labels = np.array([label for _, label, _ in rows], float)
        holders = np.bincount(numbers, minlength=len(terms))
        often = np.flatnonzero(holders * DENSE >= max(len(rows), 1))
        row_of = np.full(len(terms), -1)
        row_of[often] = np.arange(len(often))
        dense, part = np.zeros((len(often), -(-max(len(rows), 1) // BLOCK) * BLOCK)), row_of[numbers]
        dense[part[part >= 0], places[part >= 0]] = weights[part >= 0]
        return cls(terms if isinstance(terms, dict) else {term: number for number, term in enumerate(terms)}, idf, labels,
                   np.where(labels == 1, stands_for[1], stands_for[0]), [identity for identity, _, _ in rows], places, weights,
                   np.searchsorted(numbers[fresh], np.arange(len(terms) + 1)), np.append(fresh, len(numbers)), blocks[fresh], tops, row_of, dense)

    def vector(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        numbers = np.fromiter(map(self.terms.get, counts, repeat(-1)), np.int64, len(counts))
        known = numbers >= 0
        return _unit(numbers[known], np.fromiter(counts.values(), float, len(counts))[known], self.idf)

    def nearest(self, numbers: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the k nearest by falling cosine, ties by place; only examples with a cosine above 0."""
        row = self.row_of[numbers]
        often = row >= 0
        scores = weights[often] @ self.rows[row[often]]
        seldom, least = numbers[~often], 0.0
        sizes = self.first_entry[seldom + 1] - self.first_entry[seldom]
        entries, of_term = _ranges(self.first_entry[seldom], sizes), np.repeat(weights[~often], sizes)
        blocks, starts = self.entry_block[entries], self.entry_start[entries]
        lengths = self.entry_start[entries + 1] - starts
        bounds = scores.reshape(-1, BLOCK).max(axis=1)
        bounds += np.bincount(blocks, of_term * self.entry_top[entries], minlength=len(bounds))
        # First the blocks with the highest bounds, enough for k; then those that may beat the k-th cosine found.
        wanted = np.zeros(len(bounds), bool)
        wanted[np.argsort(-bounds, kind="stable")[: 1 + 2 * k // BLOCK]] = True
        whole = np.zeros(len(bounds), bool)
        while wanted.any():
            own = np.flatnonzero(wanted[blocks])
            postings = _ranges(starts[own], lengths[own])
            if len(postings):
                scores += np.bincount(self.places[postings], np.repeat(of_term[own], lengths[own]) * self.weights[postings], minlength=len(scores))
            if k < len(scores):
                # Scores of blocks not yet whole are lower bounds, so this one is too.
                least = np.partition(scores, len(scores) - k)[len(scores) - k]
            whole |= wanted
            wanted = ~whole & (bounds > 0) & (bounds >= least - 1e-9)
        found = np.flatnonzero((scores > 0) & (scores >= least - 1e-9))
        top = found[np.lexsort((found, -np.round(scores[found], 12)))[:k]]
        return top, scores[top]

    def vote(self, places: np.ndarray, cosines: np.ndarray) -> float:
        """Toxic share of the rows that the examples stand for, each weighted by the inverse of its distance."""
        closeness = self.stands_for[places] / (1.1 - np.minimum(cosines, 1.0))
        return float(closeness @ self.labels[places] / closeness.sum())


def unit_vector(counts: dict[int, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Term numbers, rising, and the weights (1 + ln tf) * idf scaled to length 1."""
    return _unit(np.fromiter(counts.keys(), np.int64, len(counts)), np.fromiter(counts.values(), float, len(counts)), idf)


def _unit(numbers: np.ndarray, times: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(numbers)
    numbers = numbers[order]
    weights = (1 + np.log(times[order])) * idf[numbers]
    return numbers, weights / math.sqrt(float(weights @ weights)) if len(numbers) else weights


def relevance(rows: list[tuple[object, int, dict[int, int]]], terms: int) -> np.ndarray:
    """sqrt(1 + chi2) of each term's presence against the label; 1 where one label is missing."""
    held = [np.zeros(terms), np.zeros(terms)]
    for _, label, counts in rows:
        held[label][np.fromiter(counts.keys(), np.int64, len(counts))] += 1
    b, a = held
    bad = sum(label for _, label, _ in rows)
    clean = len(rows) - bad
    if not (bad and clean):
        return np.ones(terms)
    chi2 = len(rows) * (a * (clean - b) - b * (bad - a)) ** 2 / (float(clean) * bad * np.maximum((a + b) * (len(rows) - a - b), 1))
    return np.sqrt(1 + chi2)


def by_likeness(rows: list[tuple[object, int, dict[int, int]]], idf: np.ndarray, terms: dict[str, int]) -> list[tuple[object, int, dict[int, int]]]:
    """The rows with similar ones side by side, which tightens block maxima: by the nearest of every BLOCK-th row."""
    seeds = BlockMaxIndex.build(terms, idf, rows[::BLOCK])
    nearest = [seeds.nearest(*unit_vector(counts, idf), 1)[0] for _, _, counts in rows]
    order = sorted(range(len(rows)), key=lambda place: (int(nearest[place][0]) if len(nearest[place]) else -1, place))
    return [rows[place] for place in order]


def isotonic(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising steps (vote, probability) by pooling neighbours that fall."""
    pools: list[list[float]] = []
    for place in np.argsort(votes, kind="stable"):
        pools.append([votes[place], votes[place], weights[place] * labels[place], weights[place]])
        while len(pools) > 1 and (pools[-2][1] == pools[-1][0] or pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]):
            _, high, hits, weight = pools.pop()
            pools[-1] = [pools[-1][0], high, pools[-1][2] + hits, pools[-1][3] + weight]
    knots = [(vote, hits / weight) for low, high, hits, weight in pools for vote in dict.fromkeys((low, high))]
    return np.array([vote for vote, _ in knots]), np.array([chance for _, chance in knots])


@dataclass
class ToxicityModel:
    index: BlockMaxIndex | None
    steps: tuple[np.ndarray, np.ndarray]
    none: float                 # probability without a neighbour

    def score(self, text: str | None) -> tuple[float, list, list[float]]:
        """Probability, and as evidence the ids and cosines of the nearest examples."""
        if self.index is not None:
            numbers, weights = self.index.vector(terms_of(text))
            if len(numbers):
                places, cosines = self.index.nearest(numbers, weights, NEIGHBOURS)
                if len(places):
                    chance = float(np.interp(self.index.vote(places, cosines), *self.steps))
                    return chance, [self.index.ids[place] for place in places], cosines.tolist()
        return self.none, [], []


def _term_rows(rows: DataFrame) -> DataFrame:
    """(key, toxic, term, n) of the rows' terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(identity, toxic, term, n)
                     for identity, toxic, text in zip(*[batch.column(place).to_pylist() for place in range(3)])
                     for term, n in terms_of(text).items()]
            columns = list(zip(*found)) or [(), (), (), ()]
            kinds = (batch.schema.field(0).type, pa.int32(), pa.string(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(columns, kinds)], ["key", "toxic", "term", "n"])

    return mapped(rows, run, rows.select("key").schema.add("toxic", "integer").add("term", "string").add("n", "integer"))


def document_frequencies(docs: DataFrame, text: str, terms: dict[str, int]) -> tuple[int, np.ndarray]:
    """Number of all documents, and of those that hold each term; what a task sends is bounded by the terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rows = Counter(), 0
        for batch in batches:
            rows += batch.num_rows
            for value in batch.column(0).to_pylist():
                counts.update(terms.keys() & set(WORD.findall((value or "").lower())))
        numbers = [terms[term] for term in counts] + [len(terms)]
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array([*counts.values(), rows], pa.int64())], ["term", "n"])

    summed = mapped(docs.select(text), run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    found = np.zeros(len(terms) + 1, np.int64)
    found[summed["term"].to_numpy()] = summed["n"].to_numpy()
    return int(found[-1]), found[:-1]


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", toxic: str = "toxic") -> ToxicityModel:
    """Sample, terms, index and calibration.  What comes to the driver are the terms of at most 2 * EXAMPLES texts."""
    known = (
        labels.where(F.col(toxic).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key)))
        .groupBy(F.col(key).alias("key")).agg(F.max(F.col(toxic).cast("int")).alias("toxic"))
    )
    shares = {row["toxic"]: row["n"] for row in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    total = sum(shares.values())
    prior = shares.get(1, 0) / total if total else 0.0
    hashed = F.md5(F.col("key").cast("string"))
    # Without the bound on the hash each task would send its own first rows; four times as many as wanted pass it.
    place = F.conv(F.substring(hashed, 1, 8), 16, 10).cast("long")
    near = lambda label: place <= int(min(1.0, 4 * EXAMPLES / shares.get(label, 1)) * 2**32)
    sample = [row for label in (0, 1) for row in
              known.where((F.col("toxic") == label) & near(label)).orderBy(hashed, "key").limit(EXAMPLES).collect()]
    if not (shares.get(0) and shares.get(1)):
        return ToxicityModel(None, (np.zeros(1), np.zeros(1)), prior)
    chosen = docs.sparkSession.createDataFrame([tuple(row) for row in sample], known.schema)
    # At most 2 * EXAMPLES ids.  One row per id: of several texts the smallest.
    texts = staged(
        docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(chosen), "key")
        .groupBy("key", "toxic").agg(F.min("text").alias("text"))
    )
    sizes = {row["toxic"]: row["n"] for row in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    clean, bad = sizes.get(0, 0), sizes.get(1, 0)
    if not clean or not bad:
        return ToxicityModel(None, (np.zeros(1), np.zeros(1)), prior)
    rows = _sample_rows(texts, sample)
    terms: dict[str, int] = {}
    numbered = [(key, label, {terms.setdefault(term, len(terms)): n for term, n in counts.items()}) for key, label, counts in rows]
    documents, frequency = document_frequencies(docs, text, terms)
    idf = np.log((1 + documents) / (1 + frequency)) + 1
    stands_for = (shares[0] / clean, shares[1] / bad)
    votes, targets, none = [], [], [0.0, 0.0]
    for fold in range(CALIBRATION_FOLDS):
        others = [row for place, row in enumerate(numbered) if place % CALIBRATION_FOLDS != fold]
        index = _index(terms, idf, others, stands_for)
        for _, label, counts in numbered[fold::CALIBRATION_FOLDS]:
            places, cosines = index.nearest(*unit_vector(counts, index.idf), NEIGHBOURS)
            if len(places):
                votes.append(index.vote(places, cosines))
                targets.append(label)
            else:
                none[label] += stands_for[label]
    # One more clean and one more toxic example at the prior keep every share inside 0 and 1.
    steps = isotonic(np.array([*votes, 0.0, 1.0]), np.array([*targets, 0.0, 1.0]), np.array([*map(stands_for.__getitem__, targets), 1.0, 1.0]))
    return ToxicityModel(_index(terms, idf, numbered, stands_for), steps, (none[1] + prior) / (sum(none) + 1))


def _sample_rows(texts: DataFrame, sample: list) -> list[tuple[object, int, dict[str, int]]]:
    """(id, label, count by term) of the sampled examples that have a text, in the sample's order."""
    found = _term_rows(texts).select("key", "term", "n").toArrow()
    counts: dict = {}
    for key, term, n in zip(*[found[name].to_pylist() for name in ("key", "term", "n")]):
        counts.setdefault(key, {})[term] = n
    return [(row["key"], row["toxic"], dict(sorted(counts.get(row["key"], {}).items()))) for row in sample]


def _index(terms: dict[str, int], idf: np.ndarray, rows: list[tuple[object, int, dict[int, int]]], stands_for: tuple[float, float]) -> BlockMaxIndex:
    weights = idf * relevance(rows, len(terms))
    return BlockMaxIndex.build(terms, weights, by_likeness(rows, weights, terms), stands_for)


OUTPUT = ("held_out", "score", "predicted", "evidence")
_EVIDENCE = T.ArrayType(T.StructType([T.StructField("example", T.StringType()), T.StructField("cosine", T.DoubleType())]))
_EVIDENCE_ARROW = pa.list_(pa.struct([("example", pa.string()), ("cosine", pa.float64())]))


def score(docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Input rows without their text, with held_out, score, predicted and evidence (nearest examples and their cosines)."""
    inner, given = sheltered(docs)
    place_of = {name: f"_in{number}" for number, name in enumerate(docs.columns)}
    keep = [place_of[name] for name in docs.columns if name != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.score(value) for value in batch.column(place_of[text]).to_pylist()]
            evidence = [[{"example": str(one), "cosine": cosine} for one, cosine in zip(ids, cosines)] for _, ids, cosines in found]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in keep], pa.array([chance for chance, _, _ in found], pa.float64()), pa.array(evidence, _EVIDENCE_ARROW)],
                [*keep, "_score", "_evidence"])

    schema = inner.select(*keep).schema.add("_score", "double").add("_evidence", _EVIDENCE)
    scored = mapped(inner.select(*keep, place_of[text]), run, schema)
    return scored.select(
        *[given[name] for name in docs.columns if name not in (text, *OUTPUT)],
        held_out(F.col(place_of[key])).alias("held_out"), F.col("_score").alias("score"),
        (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"), F.col("_evidence").alias("evidence"),
    )
