"""Counting the words and phrases of text in numpy, for ``collocations``.

A chunk of text is cut into words by masks over its bytes; equal words get one
number, and a phrase of k words is numbered by its first k - 1 words and its last
k - 1 words, so equal phrases have equal numbers and nothing rests on hashes.
Hashes name phrases in filters and in the first counts; two phrases with one hash
only look more frequent than they are, and the last count is by their spelling.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

# Bytes that end a piece and bytes between the words of a piece.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
# Bytes of text counted together; a longer text is cut where a piece ends.
CHUNK_BYTES = 1 << 20

_FOLD = bytes(
    byte + 32 if 65 <= byte <= 90 else 10 if byte in PIECE_ENDS else 32 if byte in BLANKS else byte for byte in range(256)
)
# Low bits of a phrase's hash that hold its length.
LENGTH_BITS = 3
LENGTH_MASK = (1 << LENGTH_BITS) - 1
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a phrase out of the hashes of its first and last words."""
    value = left * _MIX[0] ^ (right + _MIX[1]) * _MIX[1]
    value ^= value >> np.uint64(32)
    value *= _MIX[0]
    return value ^ (value >> np.uint64(29))


def tagged(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash with the length of its phrase in the low bits."""
    return hashes & ~np.uint64(LENGTH_MASK) | np.uint64(k)


def spelling_hashes(words: pa.Array) -> np.ndarray:
    """Hash of each word's bytes; equal words have equal hashes everywhere."""
    if not len(words):
        return np.zeros(0, np.uint64)
    words = words.cast(pa.binary())
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    letters = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]].astype(np.uint64) + np.uint64(1)
    starts, sizes = offsets[:-1] - offsets[0], np.diff(offsets)
    powers = np.cumprod(np.full(int(sizes.max()) + 1, _MIX[1]))
    letters *= powers[np.arange(len(letters)) - np.repeat(starts, sizes)]
    # The border behind the last word keeps empty words in range; they hash to 0.
    sums = np.add.reduceat(np.append(letters, np.uint64(0)), starts)
    return np.where(sizes > 0, sums, np.uint64(0))


def lang_seeds(langs: list[str]) -> np.ndarray:
    return spelling_hashes(pa.array(langs, pa.string())) * _MIX[0] + np.uint64(7)


class Filter:
    """A Bloom filter over 64-bit hashes; it may say yes too often, never no."""

    PROBES = 3

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, np.uint64(len(words) * 64 - 1)

    @staticmethod
    def places(hashes: np.ndarray, mask: int) -> list[np.ndarray]:
        step, low = (hashes >> np.uint64(33)) | np.uint64(1), hashes >> np.uint64(LENGTH_BITS)
        return [(low + np.uint64(probe) * step) & np.uint64(mask) for probe in range(Filter.PROBES)]

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for place in self.places(hashes, self.mask):
            found &= (self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
        return found


def parts(data: bytes) -> Iterator[bytes]:
    """A long text in parts that end where a piece ends; a piece beyond CHUNK_BYTES stays whole."""
    start = 0
    while len(data) - start > CHUNK_BYTES:
        end = data.rfind(b"\n", start, start + CHUNK_BYTES)
        end = end if end >= start else data.find(b"\n", start + CHUNK_BYTES)
        if end < 0:
            break
        yield data[start : end + 1]
        start = end + 1
    yield data[start:]


def chunks(rows: Iterator[tuple[str, str]]) -> Iterator[list[tuple[str, bytes]]]:
    """(lang, folded text) in lists of about CHUNK_BYTES."""
    held, size = [], 0
    for lang, text in rows:
        for part in parts(text.encode("utf-8").translate(_FOLD)):
            held.append((lang, part))
            size += len(part) + 1
            if size >= CHUNK_BYTES:
                yield held
                held, size = [], 0
    if held:
        yield held


class Words:
    """The words of a chunk in order: each one's number, and whether the next one is in the same piece."""

    def __init__(self, texts: list[tuple[str, bytes]]):
        self.langs = {lang: place for place, lang in enumerate(dict.fromkeys(lang for lang, _ in texts))}
        data = np.frombuffer(b"\n" + b"\n".join(text for _, text in texts) + b"\n", np.uint8)
        ends = np.cumsum([len(text) + 1 for _, text in texts])
        solid = (data != 32) & (data != 10)
        edges = np.flatnonzero(solid[1:] != solid[:-1]) + 1
        starts, stops = edges[0::2], edges[1::2]
        # Piece ends before a word: equal numbers mean the same piece.
        piece = np.cumsum(data == 10, dtype=np.int32)[starts]
        self.joined = piece[1:] == piece[:-1]
        offsets = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int32)
        words = pa.BinaryArray.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[solid].tobytes())]
        )
        coded = words.dictionary_encode()
        self.vocabulary = coded.dictionary.cast(pa.string())
        # A word's number tells its language too.
        lang = np.array([self.langs[one] for one, _ in texts], np.int64)[np.searchsorted(ends, starts, side="right")]
        size = max(len(self.vocabulary), 1)
        self.ids, own = pd.factorize(lang * size + coded.indices.to_numpy(zero_copy_only=False).astype(np.int64))
        self.lang_of, self.own = own // size, own % size
        self.hashes = mixed(lang_seeds(list(self.langs))[self.lang_of], spelling_hashes(coded.dictionary)[self.own])

    def totals(self) -> tuple[list[str], list[int]]:
        """Languages and their numbers of words."""
        return list(self.langs), np.bincount(self.lang_of[self.ids], minlength=len(self.langs)).tolist()

    def phrases(
        self, most: int, proposed: Filter | None = None, before: Filter | None = None, depth: int | None = None
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(k, language, words, count, hash) of the different phrases of each length k up to ``most``.

        A phrase is counted if its first and its last k - 1 words are both counted and
        ``proposed``; with ``depth``, parts longer than that need no proposal.  What the
        same rule counted under the proposals ``before`` is left out, and what is new is
        followed to its full length as if it were proposed.
        """
        starts, ids, hashes, lang_of = np.arange(len(self.ids)), self.ids, self.hashes, self.lang_of
        words = np.arange(len(self.own))[:, None]
        counted = np.full(len(hashes), before is not None)
        for k in range(1, most + 1):
            if k > 1:
                asked = proposed is not None and (depth is None or k - 1 <= depth)
                live = proposed.has(hashes) if asked else np.ones(len(hashes), bool)
                known = np.zeros(len(hashes), bool)
                if before is not None:
                    live |= ~counted
                    known = counted & before.has(hashes)
                follows = np.flatnonzero(starts[1:] == starts[:-1] + 1)
                if k == 2:
                    follows = follows[self.joined[starts[follows]]]
                follows = follows[live[ids[follows]] & live[ids[follows + 1]]]
                size = max(len(hashes), 1)
                codes, pairs = pd.factorize(ids[follows].astype(np.int64) * size + ids[follows + 1])
                first, second = pairs // size, pairs % size
                starts, ids, lang_of, counted = starts[follows], codes, lang_of[first], known[first] & known[second]
                last = words[second][:, -1]
                words, hashes = np.column_stack([words[first], last]), mixed(hashes[first], self.hashes[last])
            fresh = ~counted
            if fresh.any():
                counts = np.bincount(ids, minlength=len(hashes))
                yield k, lang_of[fresh], words[fresh], counts[fresh], hashes[fresh]

    def spelled(self, words: np.ndarray) -> pa.Array:
        """Phrases out of rows of word numbers."""
        columns = [self.vocabulary.take(pa.array(self.own[column])) for column in words.T]
        return pc.binary_join_element_wise(*columns, " ") if len(columns) > 1 else columns[0]
