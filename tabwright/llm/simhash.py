"""SimHash near-duplicates found through Golay-code fuzzy keys.

A fingerprint is the bitwise majority of the XXH64 hashes of a text's 3-word
shingles.  Fingerprints link at 3 or fewer differing bits.  Links are found
without comparing all pairs:

* The 64 bits are cut into segments A and B of 23 bits and C of 18 bits.
* The perfect (23, 12) Golay code puts each 23-bit word within 3 bits of one
  codeword.  A word at distance 3 also gets the five codewords at distance 4.
  Words that differ in at most 2 bits then share a codeword index.
* 3 errors over the segments (a, b, c) leave these cases, each with a join key:
  c <= 1 and a, b <= 2 (indices of A and B, and a half of C that is equal);
  a = 0, b <= 2 (A and index of B); b = 0, a <= 2 (index of A and B);
  a = 3 (B and C equal); b = 3 (A and C equal).
* Rows that share a key are verified on all 64 bits.

Keys are made for distinct fingerprints only, so exact copies cost nothing.  A
key's rows are not expanded into pairs: each run gives links that connect what
its pairs connect.

Defined cases: a null or wordless text has fingerprint zero and links like any
other; fewer than 3 words are one shingle.  Null ids take part, and a group's id
is its smallest id that is not null.  Repeated rows all appear in the result.  An
empty table gives an empty result.  Output columns replace input columns of the
same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabwright.llm.common import components, mapped, sheltered, staged

SHINGLE_WORDS = 3
SEED = 42
MOST_BITS = 3
# Fixed value: the generator polynomial of the binary Golay code, x^11+x^10+x^6+x^5+x^4+x^2+1.
GOLAY = 0b110001110101
# Rows of one key that are compared place by place; longer runs go through link_run.
SHORT_RUN = 32


def text_fingerprint(text: bytes | None) -> int:
    """64-bit SimHash of one UTF-8 text."""
    words = (text or b"").lower().split()  # bytes: A-Z and the six ASCII blanks only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE_WORDS:
        return xxhash.xxh64_intdigest(joined, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.concatenate(([0], np.cumsum(sizes)))
    last = SHINGLE_WORDS
    begin, end = starts[:-last].tolist(), (starts[last:] - 1).tolist()
    digest, seed = xxhash.xxh64_intdigest, SEED
    hashes = np.array([digest(joined[i:j], seed) for i, j in zip(begin, end)], dtype=np.uint64)
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(column: pa.Array) -> pa.Array:
    found = [text_fingerprint(text) for text in column.cast(pa.binary()).to_pylist()]
    return pa.array(np.array(found, dtype=np.uint64).view(np.int64), pa.int64())


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """The rows without their text, with the fingerprint as a signed long."""
    keep = [column for column in docs.columns if column not in (text, name)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(column) for column in keep]
            yield pa.RecordBatch.from_arrays([*columns, _fingerprints(batch.column(text))], [*keep, name])

    schema = docs.select(*[f"`{column}`" for column in keep]).schema.add(name, "long")
    return mapped(docs.select(*[f"`{column}`" for column in keep], f"`{text}`"), run, schema)


class GolayCode:
    """Codeword indices near 23-bit words, by syndrome."""

    def __init__(self) -> None:
        unit = [self._remainder(1 << bit) for bit in range(23)]
        self.low, self.high = self._linear(unit[:12]), self._linear(unit[12:])
        # By syndrome: up to six patterns that lead to a codeword, the nearest first; -1 fills up.
        self.leaders = np.full((2048, 6), -1, np.int64)
        filled = np.zeros(2048, np.int64)
        for weight in range(5):
            for bits in combinations(range(23), weight):
                syndrome = 0
                for bit in bits:
                    syndrome ^= unit[bit]
                if weight < 4 or self.leaders[syndrome, 0].bit_count() == 3:
                    self.leaders[syndrome, filled[syndrome]] = sum(1 << bit for bit in bits)
                    filled[syndrome] += 1

    @staticmethod
    def _remainder(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GOLAY << (bit - 11)
        return word

    @staticmethod
    def _linear(unit: list[int]) -> np.ndarray:
        table = np.zeros(1 << len(unit), np.int64)
        for bit, value in enumerate(unit):
            table[1 << bit : 2 << bit] = table[: 1 << bit] ^ value
        return table

    def indices(self, words: np.ndarray) -> np.ndarray:
        """(n, 6) indices of 12 bits; -1 where a word has no further one."""
        leaders = self.leaders[self.low[words & 0xFFF] ^ self.high[words >> 12]]
        return np.where(leaders < 0, -1, (words[:, None] ^ leaders) >> 11)


def fuzzy_keys(fingerprints: np.ndarray, code: GolayCode) -> tuple[np.ndarray, np.ndarray]:
    """(key, place of the fingerprint) for every key of every fingerprint."""
    bits = fingerprints.view(np.uint64)
    part = lambda at, size: (bits >> np.uint64(at) & np.uint64((1 << size) - 1)).astype(np.int64)
    a, b, c, c1, c2 = part(0, 23), part(23, 23), part(46, 18), part(46, 9), part(55, 9)
    near_a, near_b = code.indices(a), code.indices(b)
    both = np.where((near_a[:, :, None] < 0) | (near_b[:, None, :] < 0), -1, near_a[:, :, None] << 12 | near_b[:, None, :])
    both = both.reshape(len(bits), -1)
    tagged = lambda tag, keys: np.where(keys < 0, -1, keys | tag << 48)
    keys = np.concatenate([
        tagged(1, np.where(both < 0, -1, both << 9 | c1[:, None])),
        tagged(2, np.where(both < 0, -1, both << 9 | c2[:, None])),
        tagged(3, np.where(near_b < 0, -1, near_b << 23 | a[:, None])),
        tagged(4, np.where(near_a < 0, -1, near_a << 23 | b[:, None])),
        tagged(5, b << 18 | c)[:, None],
        tagged(6, a << 18 | c)[:, None],
    ], axis=1)
    place, column = np.nonzero(keys >= 0)
    return keys[place, column], place


def _close(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return np.bitwise_count(one.view(np.uint64) ^ two.view(np.uint64)) <= MOST_BITS


def _groups(size: int, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Smallest place of each place's group under the links one[i] - two[i]."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[one], label[two])
        np.minimum.at(label, label[one], low)
        np.minimum.at(label, label[two], low)
        while (label != label[label]).any():
            label = label[label]
        if (label[one] == label[two]).all():
            return label


def link_run(values: np.ndarray) -> np.ndarray:
    """Group labels of distinct fingerprints that share a key, as if all pairs had been compared.

    Sorting with three neighbouring bits masked links most of a large group in a
    few passes.  Only what lies outside the largest group is then compared with
    all others, so a run of near copies costs about its length.
    """
    bits = values.view(np.uint64)
    varying = [bit for bit in range(64) if int(np.bitwise_or.reduce(bits ^ bits[0])) >> bit & 1]
    one, two = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(max(1, len(varying) - MOST_BITS + 1)):
        mask = sum(1 << bit for bit in varying[at : at + MOST_BITS])
        masked = bits & np.uint64(~mask & (1 << 64) - 1)
        order = np.argsort(masked, kind="stable")
        same = np.nonzero(masked[order[1:]] == masked[order[:-1]])[0]
        one.append(order[same])
        two.append(order[same + 1])
    label = _groups(len(bits), np.concatenate(one), np.concatenate(two))
    largest = np.bincount(label).argmax()
    outside = np.nonzero(label != largest)[0]
    one, two = [], []
    for place in outside:
        near = np.nonzero(np.bitwise_count(bits ^ bits[place]) <= MOST_BITS)[0]
        near = near[label[near] != label[place]]
        if len(near):
            _, first = np.unique(label[near], return_index=True)
            one.append(np.full(len(first), place))
            two.append(near[first])
    if one:
        top = _groups(len(bits), np.concatenate([np.arange(len(bits)), *one]), np.concatenate([label, *two]))
        return top
    return label


def _links(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows sorted by key, then value; complete runs only."""
    starts = np.nonzero(np.concatenate(([True], keys[1:] != keys[:-1])))[0]
    sizes = np.diff(np.concatenate((starts, [len(keys)])))
    one, two = [], []
    for start, size in zip(starts[sizes > SHORT_RUN], sizes[sizes > SHORT_RUN]):
        run = values[start : start + size]
        label = link_run(run)
        linked = np.nonzero(label != np.arange(size))[0]
        one.append(run[label[linked]])
        two.append(run[linked])
    small = np.repeat(sizes <= SHORT_RUN, sizes)
    keys, values = keys[small], values[small]
    for step in range(1, SHORT_RUN):
        at = np.nonzero(keys[step:] == keys[:-step])[0] if len(keys) > step else []
        if not len(at):
            break
        at = at[_close(values[at], values[at + step])]
        one.append(values[at])
        two.append(values[at + step])
    if not one:
        return values[:0], values[:0]
    pairs = np.unique(np.stack([np.concatenate(one), np.concatenate(two)], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def links(fingerprints: DataFrame) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints (distinct longs, one column) that a chain of close pairs connects."""
    name = fingerprints.columns[0]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = GolayCode()
        for batch in batches:
            values = batch.column(0).to_numpy()
            for at in range(0, len(values), 4096):
                part = np.ascontiguousarray(values[at : at + 4096])
                keys, place = fuzzy_keys(part, code)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[place])], ["key", "value"])

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_keys, open_values = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for batch in batches:
            keys, values = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(keys):
                continue
            cut = int(np.searchsorted(keys, keys[-1]))  # the last key may go on in the next batch
            if cut or open_keys[-1].size and open_keys[-1][-1] != keys[0]:
                one, two = _links(np.concatenate([*open_keys, keys[:cut]]), np.concatenate([*open_values, values[:cut]]))
                yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(two)], ["a", "b"])
                open_keys, open_values = [], []
            open_keys.append(keys[cut:])
            open_values.append(values[cut:])
        keys, values = np.concatenate(open_keys), np.concatenate(open_values)
        if len(keys):
            one, two = _links(keys, values)
            yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(two)], ["a", "b"])

    keyed = mapped(fingerprints.select(name), emit, "key long, value long")
    return mapped(keyed.repartition("key").sortWithinPartitions("key", "value"), match, "a long, b long")


OUTPUT = ("fingerprint", "component_id")


def _groups_of(rows: DataFrame) -> DataFrame:
    """(_print, root, component_id) of every distinct fingerprint of rows (_key, _print)."""
    prints = rows.groupBy("_print").agg(F.min("_key").alias("_least"))
    labels = components(links(prints.select("_print"))).withColumnRenamed("node", "_print")
    rooted = prints.join(labels, "_print", "left").withColumn("root", F.coalesce("root", "_print"))
    least = rooted.groupBy("root").agg(F.min("_least").alias("component_id"))
    return rooted.join(least, "root").select("_print", "root", "component_id")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Input rows without their text, with fingerprint (hexadecimal) and component_id.

    Fingerprints are made once and written with the rows.  The join back splits
    a fingerprint with many copies.
    """
    inner, given = sheltered(docs)
    inside = f"_in{docs.columns.index(text)}"
    rows = staged(with_fingerprint(inner.withColumn("_key", given[key]), inside, "_print"))
    return rows.join(_groups_of(rows).select("_print", "component_id"), "_print").select(
        *[given[name] for name in docs.columns if name not in (*OUTPUT, text)],
        F.lower(F.lpad(F.hex("_print"), 16, "0")).alias("fingerprint"), "component_id",
    )


def one_per_group(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group: the one with the smallest id, in full.

    Rows that repeat that id leave one row, the one with the smallest text.
    Groups in which no row has an id keep their smallest text.  Only ids and
    fingerprints go through the search; texts are shuffled once, by id.
    """
    inner, given = sheltered(docs)
    rows = staged(with_fingerprint(inner.select(given[key].alias("_key"), given[text].alias("_text")), "_text", "_print"))
    groups = staged(_groups_of(rows))
    first = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("_text"))
    chosen = groups.where("component_id is not null").select(F.col("component_id").alias("_key")).distinct()
    known = (
        inner.select("*", given[key].alias("_key"), given[text].alias("_text")).join(chosen, "_key")
        .withColumn("_place", first("_key")).where("_place = 1").select(*given.values())
    )
    nameless = inner.where(given[key].isNull()).select(F.struct(*inner.columns).alias("_row"), given[text].alias("_kept_text"))
    nameless = nameless.withColumn("_text", F.col("_kept_text"))
    printed = with_fingerprint(nameless, "_text", "_print").withColumnRenamed("_kept_text", "_text")
    unknown = (
        printed.join(groups.where("component_id is null"), "_print")
        .withColumn("_place", first("root")).where("_place = 1").select("_row.*").select(*given.values())
    )
    return known.unionByName(unknown)
