"""Pieces of many texts at once, as Arrow arrays cut out of the texts' own bytes.

What costs time per word (looking up or encoding it) is then done once for each
different word of a slice of texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text that are cut together; a longer text stands alone.
SLICE_BYTES = 4 << 20
# A-Z in lower case, the six ASCII blanks as a space.
LOWER = bytes(32 if byte in b" \t\n\x0b\x0c\r" else byte + 32 if 65 <= byte <= 90 else byte for byte in range(256))


def bytes_and_ends(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    """The texts' bytes in a row, and 0 and their ends there; a null text is empty."""
    texts = texts.fill_null("")
    if not len(texts):
        return b"", np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64 if pa.types.is_large_string(texts.type) else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return (data.slice(ends[0], ends[-1] - ends[0]).to_pybytes() if data is not None else b""), ends - ends[0]


def slices(batch: pa.RecordBatch, column: int | str) -> Iterator[pa.RecordBatch]:
    """The rows, about SLICE_BYTES of the column's text at a time."""
    _, ends = bytes_and_ends(batch.column(column))
    at = 0
    while at < batch.num_rows:
        last = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE_BYTES, side="right")) - 1)
        yield batch.slice(at, last - at)
        at = last


def cut(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The bytes from each start to the next, as an array of bytes."""
    ends = np.append(starts, len(data)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def different(pieces: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """Number of each piece among the different ones, and these."""
    coded = pieces.dictionary_encode()
    # Much faster than to_pylist.
    return coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()


def lower_words(texts: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Number of each word of the texts among the different words, these in lower case, and the words of each text."""
    data, ends = bytes_and_ends(texts)
    data = np.frombuffer(data.translate(LOWER), np.uint8)
    inside = data != 32
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[ends[:-1][ends[:-1] < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    places = np.cumsum(inside)[starts] - 1
    numbers, words = different(cut(data[inside], places))
    return numbers, words, np.diff(np.searchsorted(starts, ends))


def joined(parts: list[bytes], numbers: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The parts of the given numbers in a row, as unsigned integers of ``width`` bytes, and how many each has."""
    flat = np.frombuffer(b"".join(parts), f"<u{width}")
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // width
    starts = np.cumsum(sizes) - sizes
    own = sizes.take(numbers)
    ends = np.cumsum(own)
    # Half as wide where that is enough, as it nearly always is.
    kind = np.int32 if max(len(flat), int(ends[-1]) if len(ends) else 0) < 1 << 31 else np.int64
    places = np.repeat((starts.take(numbers) - (ends - own)).astype(kind), own)
    places += np.arange(len(places), dtype=kind)
    return flat.take(places), own
