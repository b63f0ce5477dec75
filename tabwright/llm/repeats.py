"""Exact removal of long strings that occur twice or more, by distributed suffix sorting.

A byte goes if a string of LENGTH bytes that covers it also starts anywhere else,
in the same document or another; strings are judged on the input.

Suffixes of a corpus do not fit one machine, so equal strings must meet first.
Each string of LENGTH bytes has an anchor: among its runs of ANCHOR bytes the one
with the smallest hash (the last of ties), so equal strings have equal anchors.
Neighbouring strings mostly share their anchor; the stretch of text that an
anchor's strings cover is its context.

1. Anchors and contexts are counted by hash, per batch first; an anchor that
   occurs once ends here.
2. One copy of each different context of the other anchors is cut from its text,
   and contexts of one anchor come to one task.  Those of an anchor with more
   than GROUP_BYTES of them are cut into their strings, which meet by their own
   hash, so the anchor spreads over tasks.
3. There the suffixes of the contexts are sorted in two stages and neighbours
   with a common prefix of LENGTH bytes are marked; a context that occurs several
   times is marked whole.  Strings that came alone are compared as they are
   read.  Hashes only bring strings together; marks between
   different contexts rest on their bytes.
4. Marks go back to all occurrences of a context and are united per document.

Defined cases: a null text is empty; texts shorter than LENGTH lose nothing.
Repeated rows are occurrences of their own, so both lose what they share.  An
empty table gives an empty result.  Output columns replace input columns of the
same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm.common import mapped, sheltered
from tabwright.llm.suffix_sort import common_prefixes, suffix_array

LENGTH = 200
ANCHOR = 32
# Bytes that are hashed at once, and bytes of contexts that are sorted at once (whole anchors, so up to GROUP_BYTES more).
BLOCK, SORTED = 1 << 20, 1 << 18
# Bytes of the different contexts of one anchor that are sorted together at most.
GROUP_BYTES = 1 << 21
# Rows that are handed on together.
ROWS = 8192
PLACE_BITS = 24
MULTIPLIER = 0x9E3779B97F4A7C15


def _powers(base: int, count: int) -> np.ndarray:
    table = np.full(count, base, np.uint64)
    table[0] = 1
    return np.multiply.accumulate(table)


class Anchors:
    """Rolling hashes and smallest-hash anchors of blocks of text."""

    def __init__(self) -> None:
        size = 2 * BLOCK + LENGTH + 2
        self.up, self.down = _powers(MULTIPLIER, size), _powers(pow(MULTIPLIER, -1, 1 << 64), size)

    @staticmethod
    def _mixed(value: np.ndarray) -> np.ndarray:
        value = value ^ value >> np.uint64(29)
        value = value * np.uint64(0xBF58476D1CE4E5B9)
        return value ^ value >> np.uint64(32)

    def of(self, parts: list[bytes]) -> tuple[np.ndarray, ...]:
        """(part, first string, strings, anchor hash, context hash) of every anchor's stretch, places within the part."""
        codes = np.frombuffer(b"".join(parts), np.uint8)
        ends = np.cumsum([len(part) for part in parts])
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * self.down[: len(codes)], out=sums[1:])
        hashes = self._mixed((sums[ANCHOR:] - sums[:-ANCHOR]) * self.up[: len(codes) - ANCHOR + 1])
        low = np.uint64((1 << PLACE_BITS) - 1)
        ranked = (hashes & ~low) | (low - np.arange(len(hashes), dtype=np.uint64))
        window, width, least = LENGTH - ANCHOR + 1, 1, ranked
        while 2 * width <= window:
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
        least = np.minimum(least[: len(ranked) - window + 1], least[window - width :])
        anchor = (low - (least & low)).astype(np.int64)

        part = np.searchsorted(ends, np.arange(len(anchor)), side="right")
        valid = np.arange(len(anchor)) + LENGTH <= ends[part]
        new = valid.copy()
        new[1:] &= (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])
        first = np.nonzero(new)[0]
        # Strings of a stretch are consecutive: it ends before the next stretch or at the last valid string of its part.
        last = np.minimum(np.append(first[1:], len(anchor)) - 1, ends[part[first]] - LENGTH)
        context = (sums[last + LENGTH] - sums[first]) * self.up[first] + (last - first).astype(np.uint64)
        begin = np.concatenate(([0], ends))[part[first]]
        return (part[first], first - begin, last - first + 1,
                hashes[anchor[first]].view(np.int64), self._mixed(context).view(np.int64))


def _row_key(identity: object, text: bytes) -> tuple[int, int]:
    """88 bits that name a row by its id and text: a signed long, and 24 bits that travel with the place."""
    digest = xxhash.xxh3_128_intdigest(repr(identity).encode() + b"\0" + text)
    return (digest >> 64) - (1 << 63), digest & (1 << PLACE_BITS) - 1


def _packed(extra: np.ndarray, start: np.ndarray, strings: np.ndarray) -> np.ndarray:
    return extra << 40 | start << 8 | strings


def _occurrences(batch: pa.RecordBatch, anchors: Anchors) -> Iterator[tuple[np.ndarray, ...]]:
    """(hash, context, key, place) of all anchors of a batch with columns id, text; a block at a time."""
    parts, keys, extras, offsets, held = [], [], [], [], 0

    def flush() -> tuple[np.ndarray, ...]:
        part, first, strings, hashes, context = anchors.of(parts)
        start = first + np.array(offsets, np.int64)[part]
        return hashes, context, np.array(keys, np.int64)[part], _packed(np.array(extras, np.int64)[part], start, strings)

    for identity, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
        if text is None or len(text) < LENGTH:
            continue
        key, extra = _row_key(identity, text)
        for offset in range(0, len(text) - LENGTH + 1, BLOCK):
            piece = text[offset : offset + BLOCK + LENGTH - 1]
            parts.append(piece)
            keys.append(key)
            extras.append(extra)
            offsets.append(offset)
            held += len(piece)
            if held >= BLOCK:
                yield flush()
                parts, keys, extras, offsets, held = [], [], [], [], 0
    if parts:
        yield flush()


def _anchors_of(rows: DataFrame) -> DataFrame:
    """One row (hash, context, key, place) per occurrence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors()
        for batch in batches:
            for columns in _occurrences(batch, anchors):
                yield pa.RecordBatch.from_arrays([pa.array(column) for column in columns], ["hash", "context", "key", "place"])

    return mapped(rows, run, "hash long, context long, key long, place long")


def _contexts_of(rows: DataFrame) -> DataFrame:
    """(hash, context, key, place, n): each different context of a batch once, with one occurrence and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors()
        for batch in batches:
            found = list(_occurrences(batch, anchors))
            if not found:
                continue
            hashes, context, key, place = (np.concatenate(column) for column in zip(*found))
            order = np.lexsort((place, key, context, hashes))
            hashes, context, key, place = hashes[order], context[order], key[order], place[order]
            first = np.nonzero(np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (context[1:] != context[:-1]))))[0]
            n = np.diff(np.append(first, len(hashes)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(column[first]) for column in (hashes, context, key, place)] + [pa.array(n)],
                ["hash", "context", "key", "place", "n"])

    return mapped(rows, run, "hash long, context long, key long, place long, n long")


def _stored(inner: DataFrame, key: str, text: str, keep: list[str]) -> DataFrame:
    """Kept columns, the row's key, and its text compressed for the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            texts = [value or b"" for value in batch.column(text).cast(pa.binary()).to_pylist()]
            keys = [_row_key(identity, value)[0] for identity, value in zip(batch.column(key).to_pylist(), texts)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in keep], pa.array(keys, pa.int64()), pa.array(map(pack, texts), pa.binary())],
                [*keep, "key", "packed"])

    columns = list(dict.fromkeys([*keep, key, text]))
    return mapped(inner.select(*columns), run, inner.select(*keep).schema.add("key", "long").add("packed", "binary"))


def _cut(stored: DataFrame, wanted: DataFrame) -> DataFrame:
    """(hash, context, n, strings, content, meet, first) of one occurrence of each wanted context; wanted: (key, list of places).

    Contexts meet by their anchor's hash, with first -1.  Spread ones are cut into
    strings with their place in the context, which meet by their own hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        kinds = {"hash": pa.int64(), "context": pa.int64(), "n": pa.int64(), "strings": pa.int32(), "content": pa.binary(),
                 "meet": pa.int64(), "first": pa.int32()}

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(columns, kinds.values())], [*kinds])

        rows: list[tuple] = []
        for batch in batches:
            for packed, items in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = unpack(packed)
                for item in items:
                    start, strings = item["place"] >> 8 & 0xFFFFFFFF, item["place"] & 0xFF
                    name = (item["hash"], item["context"], item["n"])
                    if item["spread"]:
                        for first in range(strings):
                            string = text[start + first : start + first + LENGTH]
                            rows.append((*name, 1, string, xxhash.xxh3_64_intdigest(string) - (1 << 63), first))
                    else:
                        rows.append((*name, strings, text[start : start + strings + LENGTH - 1], item["hash"], -1))
                    if len(rows) >= ROWS:
                        yield out(rows)
                        rows = []
        if rows:
            yield out(rows)

    joined = stored.join(wanted, "key").select("packed", "wanted")
    return mapped(joined, run, "hash long, context long, n long, strings int, content binary, meet long, first int")


def _meeting(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """What ``_cut`` gives for the different contexts of all anchors that occur twice; rows: (id, text)."""
    by_hash = Window.partitionBy("hash")
    different = _contexts_of(rows).repartition("hash").groupBy("hash", "context").agg(
        F.min(F.struct("key", "place")).alias("one"), F.sum("n").alias("n"))
    size = F.col("one.place").bitwiseAND(0xFF) + F.lit(LENGTH - 1)
    repeated = different.withColumns({"all": F.sum("n").over(by_hash), "spread": F.sum(size).over(by_hash) > GROUP_BYTES}).where("all > 1")
    wanted = repeated.groupBy(F.col("one.key").alias("key")).agg(
        F.collect_list(F.struct("hash", "context", "n", F.col("one.place").alias("place"), "spread")).alias("wanted"))
    return _cut(stored, wanted)


def marked_strings(contents: list[bytes], strings: list[int], whole: list[bool]) -> list[list[tuple[int, int]]]:
    """Per context the ranges (first, last + 1) of its strings that also start elsewhere in these contexts or are marked whole."""
    text = b"".join(contents)
    begins = np.concatenate(([0], np.cumsum([len(content) for content in contents])))
    owner = np.repeat(np.arange(len(contents)), np.diff(begins))
    order = suffix_array(text, LENGTH)
    within = order - begins[owner[order]]
    order = order[within < np.array(strings)[owner[order]]]
    same = common_prefixes(text, order, LENGTH) >= LENGTH
    marked = np.zeros(len(text) + 1, bool)
    marked[order[:-1][same]] = True
    marked[order[1:][same]] = True
    ranges = []
    for at, count, all_of in zip(begins.tolist(), strings, whole):
        if all_of:
            ranges.append([(0, count)])
            continue
        edge = np.diff(np.concatenate(([0], marked[at : at + count].view(np.int8), [0])))
        ranges.append(list(zip(np.nonzero(edge > 0)[0].tolist(), np.nonzero(edge < 0)[0].tolist())))
    return ranges


def _marks(contexts: DataFrame) -> DataFrame:
    """(hash, context, first, last) for every range of repeated strings; contexts of one anchor are sorted together, strings that came alone compared."""

    def out(flat: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*flat)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
            ["hash", "context", "first", "last"])

    def sort(rows: list[tuple]) -> pa.RecordBatch:
        ranges = marked_strings([row[4] for row in rows], [row[3] for row in rows], [row[2] > 1 for row in rows])
        return out([(row[0], row[1], first, last) for row, own in zip(rows, ranges) for first, last in own])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        # Per string of one hash its first row, or None once that is marked.
        meet, seen, found = None, {}, []
        for batch in batches:
            for row in zip(*[column.to_pylist() for column in batch.columns]):
                if row[6] >= 0:
                    if row[5] != meet:
                        meet, seen = row[5], {}
                    mark = (row[0], row[1], row[6], row[6] + 1)
                    if row[4] in seen:
                        found += [one for one in (seen[row[4]], mark) if one]
                        seen[row[4]] = None
                    elif row[2] > 1:
                        found.append(mark)
                        seen[row[4]] = None
                    else:
                        seen[row[4]] = mark
                    if len(found) >= ROWS:
                        yield out(found)
                        found = []
                    continue
                if held >= SORTED and row[0] != rows[-1][0]:
                    yield sort(rows)
                    rows, held = [], 0
                rows.append(row)
                held += len(row[4])
        if rows:
            yield sort(rows)
        if found:
            yield out(found)

    return mapped(contexts.repartition("meet").sortWithinPartitions("meet", "context"), run,
                  "hash long, context long, first int, last int")


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_SPANS_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
OUTPUT = ("n_bytes", "n_removed", "n_spans", "spans", "kept")


def _without(joined: DataFrame, keep: list[str], schema: T.StructType) -> DataFrame:
    """Unite each row's marked strings and cut them from its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            sizes, removed, spans, kept = [], [], [], []
            for packed, marks in zip(batch.column("packed").to_pylist(), batch.column("marks").to_pylist()):
                text = unpack(packed)
                edges: list[tuple[int, int]] = []
                for mark in sorted(marks or [], key=lambda mark: mark["first"]):
                    start, end = mark["first"], mark["last"] + LENGTH - 1
                    if edges and start <= edges[-1][1]:
                        edges[-1] = (edges[-1][0], max(edges[-1][1], end))
                    else:
                        edges.append((start, end))
                at, rest = 0, []
                for start, end in edges:
                    rest.append(text[at:start])
                    at = end
                rest.append(text[at:])
                kept.append(b"".join(rest))
                sizes.append(len(text))
                removed.append(len(text) - len(kept[-1]))
                spans.append([{"start": start, "end": end} for start, end in edges])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in keep], pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(map(len, spans), pa.int64()), pa.array(spans, _SPANS_ARROW), pa.array(kept, pa.binary())],
                [*keep, *OUTPUT])

    return mapped(joined, run, schema)


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Input rows without their text, with n_bytes, n_removed, n_spans, spans (maximal removed runs) and kept (binary: a cut may split a character)."""
    inner, given = sheltered(docs)
    place_of = {name: f"_in{number}" for number, name in enumerate(docs.columns)}
    keep = [place_of[name] for name in docs.columns if name not in (text, *OUTPUT)]
    rows = inner.select(place_of[key], place_of[text])
    stored = _stored(inner, place_of[key], place_of[text], keep)

    marks = _marks(_meeting(rows, stored))

    occurrences = _anchors_of(rows).join(marks, ["hash", "context"])
    start = F.shiftrightunsigned("place", 8).bitwiseAND(0xFFFFFFFF)
    per_row = occurrences.select("key", (start + F.col("first")).alias("first"), (start + F.col("last")).alias("last")).groupBy("key").agg(
        F.collect_set(F.struct("first", "last")).alias("marks"))
    joined = stored.join(per_row, "key", "left").select(*keep, "packed", "marks")
    schema = inner.select(*keep).schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long")
    found = _without(joined, keep, schema.add("spans", SPANS).add("kept", "binary"))
    return found.select(*[given[name] for name in docs.columns if name not in (text, *OUTPUT)], *OUTPUT)
