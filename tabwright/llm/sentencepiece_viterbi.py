"""SentencePiece encoding and decoding with a streaming Viterbi search.

The search walks over the characters and keeps, for each position, the best
path of pieces that ends there: a back pointer and the last piece.  A later
piece can start only within the longest piece's length of the end, so whenever
the paths to all those positions pass through one boundary, the ids up to it are
final: they are emitted and forgotten.

Which path is best depends on the model.  In a ``unigram`` model it has the
largest sum of piece scores.  In a ``bpe`` model a path is admissible if merging
each two neighbouring pieces by themselves gives back these two pieces; exactly
one path to each position is, and it is what merging the whole prefix gives.

Space becomes U+2581 and one is put in front; characters that stand in no piece
become byte pieces.  U+2581 in a text becomes byte pieces too, so decoding gives
back every text exactly.

Defined cases: a null text is empty and has no ids.  Repeated rows have equal
ids; an empty table gives an empty result.  Output columns replace input columns
of the same name.  The model's path is a parameter; nothing is trained.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm.common import mapped, sheltered

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BLANK = "▁"
# A character without a piece of its own, in paths.
BYTES = -2
START = -1
UNKNOWN_COST = 10.0
# Units of up to this length are remembered, at most so many in a Python worker.
UNIT_CHARS, UNITS = 64, 800_000
PAIRS = 2_000_000


class PieceModel:
    """Pieces, scores and the two directions of one model file."""

    def __init__(self, path: str, kind: str = "bpe"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.kind, self.ids, self.scores, self.byte_ids, self.content = kind, {}, [], {}, []
        for number in range(model.get_piece_size()):
            piece = model.id_to_piece(number)
            self.scores.append(model.get_score(number))
            if model.is_byte(number):
                value = int(piece[3:-1], 16)
                self.byte_ids[value] = number
                self.content.append(bytes([value]))
            elif model.is_control(number) or model.is_unknown(number) or model.is_unused(number):
                self.content.append(b"")
            else:
                self.ids[piece] = number
                self.content.append(piece.replace(BLANK, " ").encode())
        self.pieces = {number: piece for piece, number in self.ids.items()}
        # Every beginning of a piece: its id, or -1 if it is only a beginning.
        self.starts = {piece[:size]: -1 for piece in self.ids for size in range(1, len(piece))} | self.ids
        # Characters that stand side by side in some piece; any other two are a boundary of every path.
        self.neighbours = {piece[place : place + 2] for piece in self.ids for place in range(len(piece) - 1)}
        self.longest = max(map(len, self.ids))
        self.alphabet = set("".join(self.ids))
        self.lowest = min(self.scores) - UNKNOWN_COST
        self.fits: dict[int, bool] = {}
        if any(BLANK in piece.lstrip(BLANK) for piece in self.ids):
            raise ValueError("pieces that go on after a blank are not supported")
        # No piece crosses from a character to a blank, nor holds a line break: these places are boundaries of every path.
        self.unit = re.compile(f"\n|{BLANK}+[^{BLANK}\n]*|[^{BLANK}\n]+") if "\n" not in self.alphabet else re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")
        self.known = _Units(self)

    def merged(self, text: str) -> list[str]:
        """Symbols after merging by score, leftmost first: what a BPE model makes of a text by itself."""
        symbols = list(text)
        while len(symbols) > 1:
            best, at = None, -1
            for place in range(len(symbols) - 1):
                number = self.ids.get(symbols[place] + symbols[place + 1])
                if number is not None and (best is None or self.scores[number] > best):
                    best, at = self.scores[number], place
            if best is None:
                return symbols
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def admits(self, last: int, piece: int) -> bool:
        """Whether merging leaves ``last`` and ``piece`` as they are when they stand side by side."""
        if piece == BYTES:
            return True
        pair = (last + 2) << 32 | piece
        known = self.fits.get(pair)
        if known is None:
            right = self.pieces[piece]
            parts = [right] if last < 0 else [self.pieces[last], right]
            known = self.merged("".join(parts)) == parts
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            self.fits[pair] = known
        return known

    def ids_of(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        # U+2581 of the text itself goes to byte pieces; no path crosses those.
        first, *rest = text.split(BLANK)
        out = self._searched(BLANK + first)
        if rest:
            own = b"".join(self.byte_ids[value].to_bytes(4, "little") for value in BLANK.encode())
            out += b"".join(own + self._searched(part) for part in rest)
        return out

    def _searched(self, part: str) -> bytes:
        return b"".join(map(self.known.__getitem__, self.unit.findall(part.replace(" ", BLANK))))

    def text_of(self, ids: bytes) -> str:
        """The text that a sequence of ids stands for."""
        content = b"".join(map(self.content.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return content[1:].decode()

    def merged_ids(self, text: str) -> list[int]:
        """Ids after merging a whole text of known characters; slow, for comparison."""
        return [self.ids[symbol] for symbol in self.merged(text)]

    def search(self) -> StreamingViterbi:
        return StreamingViterbi(self)


class _Units(dict):
    """Ids of the stretches between sure boundaries, remembered while they are short and few."""

    def __init__(self, model: PieceModel):
        super().__init__()
        self.model = model

    def __missing__(self, unit: str) -> bytes:
        neighbours = self.model.neighbours
        cuts = [place for place in range(1, len(unit)) if unit[place - 1 : place + 1] not in neighbours] if len(unit) <= UNIT_CHARS else []
        if cuts:
            return b"".join(map(self.__getitem__, map(unit.__getitem__, map(slice, [0, *cuts], [*cuts, None]))))
        search = self.model.search()
        ids = np.array([*search.feed(unit), *search.finish()], "<u4").tobytes()
        if len(unit) <= UNIT_CHARS:
            if len(self) >= UNITS:
                self.clear()
            self[unit] = ids
        return ids


class StreamingViterbi:
    """Feed characters in parts of any size; final ids come out as soon as they are sure."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.window = ""            # characters after the last committed boundary
        self.next = 0               # first position whose pieces are still to be tried
        self.back = [0]             # per position of the window: where the best last piece starts, -1 if none yet
        self.last = [START]         # and that piece
        self.score = [0.0]

    def feed(self, chars: str) -> list[int]:
        out: list[int] = []
        span = 4 * self.model.longest
        for at in range(0, len(chars), span):
            self.window += chars[at : at + span]
            if len(self.window) > span:
                self._extend(len(self.window) - self.model.longest)
                out += self._commit()
        return out

    def _extend(self, until: int) -> None:
        """Try all pieces that start before ``until``."""
        model, window, back, last, score = self.model, self.window, self.back, self.last, self.score
        starts, fits, size, unigram = model.starts.get, model.fits, len(window), model.kind == "unigram"
        missing = size + 1 - len(back)
        back += [-1] * missing
        last += [BYTES] * missing
        score += [0.0] * missing
        for at in range(self.next, until):
            if back[at] < 0:
                continue
            before = last[at]
            if starts(window[at]) is None or window[at] not in model.ids:
                if back[at + 1] < 0 or unigram and score[at] + model.lowest > score[at + 1]:
                    back[at + 1], last[at + 1], score[at + 1] = at, BYTES, score[at] + model.lowest
            tag = (before + 2) << 32
            for end in range(at + 1, size + 1):
                number = starts(window[at:end])
                if number is None:
                    break
                if number < 0:
                    continue
                if unigram:
                    value = score[at] + model.scores[number]
                    if back[end] < 0 or value > score[end]:
                        back[end], last[end], score[end] = at, number, value
                elif back[end] < 0:
                    fit = fits.get(tag | number)
                    if fit or fit is None and model.admits(before, number):
                        back[end], last[end] = at, number
        self.next = max(self.next, until)

    def _commit(self) -> list[int]:
        """Ids up to the boundary that the paths to all positions still in reach have in common."""
        heads = {place for place in range(self.next, len(self.window) + 1) if self.back[place] >= 0}
        while len(heads) > 1:
            furthest = max(heads)
            heads.remove(furthest)
            heads.add(self.back[furthest])
        boundary = heads.pop()
        out = self._path(boundary)
        if boundary:
            # The boundary's last piece stays known: the next piece has to fit it.
            self.window, self.score, self.next = self.window[boundary:], self.score[boundary:], self.next - boundary
            self.back, self.last = [max(at - boundary, -1) for at in self.back[boundary:]], self.last[boundary:]
            self.back[0] = 0
        return out

    def _path(self, end: int) -> list[int]:
        out: list[int] = []
        while end > 0:
            start = self.back[end]
            if self.last[end] == BYTES:
                out += [self.model.byte_ids[value] for value in reversed(self.window[start:end].encode())]
            else:
                out.append(self.last[end])
            end = start
        return out[::-1]

    def finish(self) -> list[int]:
        self._extend(len(self.window))
        out = self._path(len(self.window))
        self.__init__(self.model)
        return out


@lru_cache(maxsize=2)
def piece_model(path: str, kind: str) -> PieceModel:
    """One model per Python worker and path."""
    return PieceModel(path, kind)


def encode(docs: DataFrame, text: str = "text", model: str = MODEL, kind: str = "bpe") -> DataFrame:
    """Input rows without their text, with ``ids`` (array of int)."""
    inner, given = sheltered(docs)
    inside = f"_in{docs.columns.index(text)}"
    keep = [name for name in inner.columns if name != inside]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_model(model, kind)
        for batch in batches:
            coded = [np.frombuffer(pieces.ids_of(value), "<i4") for value in batch.column(inside).to_pylist()]
            ends = np.cumsum([0, *map(len, coded)], dtype=np.int64)
            flat = pa.array(np.concatenate([np.zeros(0, "<i4"), *coded]), pa.int32())
            ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat)
            yield pa.RecordBatch.from_arrays([*[batch.column(name) for name in keep], ids], [*keep, "_ids"])

    schema = inner.select(*keep).schema.add("_ids", T.ArrayType(T.IntegerType()))
    found = mapped(inner.select(*keep, inside), run, schema)
    return found.select(*[given[name] for name in docs.columns if name not in (text, "ids")], F.col("_ids").alias("ids"))


def decode(rows: DataFrame, ids: str = "ids", name: str = "text", model: str = MODEL, kind: str = "bpe") -> DataFrame:
    """Input rows without their ids, with the text they stand for; null ids give a null text."""
    inner, given = sheltered(rows)
    inside = f"_in{rows.columns.index(ids)}"
    keep = [column for column in inner.columns if column != inside]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_model(model, kind)
        for batch in batches:
            texts = [None if value is None else pieces.text_of(np.array(value, "<u4").tobytes()) for value in batch.column(inside).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(column) for column in keep], pa.array(texts, pa.string())], [*keep, "_text"])

    schema = inner.select(*keep).schema.add("_text", T.StringType())
    found = mapped(inner.select(*keep, inside), run, schema)
    return found.select(*[given[column] for column in rows.columns if column not in (ids, name)], F.col("_text").alias(name))


def digest(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str = MODEL, kind: str = "bpe") -> DataFrame:
    """Per row: key, n_tokens, ids_crc32, and of the text decoded from the ids n_bytes, decoded_sha256 and whether it is the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_model(model, kind)
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            for value in batch.column(1).to_pylist():
                coded = pieces.ids_of(value)
                back = pieces.text_of(coded)
                data = back.encode()
                row = (len(coded) // 4, zlib.crc32(coded), len(data), hashlib.sha256(data).hexdigest(), back == (value or ""))
                for column, item in zip(columns, row):
                    column.append(item)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, columns, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()))],
                [key, "n_tokens", "ids_crc32", "n_bytes", "decoded_sha256", "round_trip"])

    rows = docs.select(F.col(key), F.col(text))
    schema = rows.select(key).schema.add("n_tokens", "long").add("ids_crc32", "long").add("n_bytes", "long")
    return mapped(rows, run, schema.add("decoded_sha256", "string").add("round_trip", "boolean"))
