"""Context-mixing range coder for token ids, many blocks side by side in numpy.

A file image is a header, an index of its documents, an index of its blocks and
the blocks' code words.  Each block starts with a fresh model and has a checksum,
so it can be decoded and verified by itself.  An image has about ``LANES`` blocks
of at least ``LEAST_BLOCK`` and at most ``BLOCK`` ids.

Per id the model makes three predictions: the id that last followed the same two
ids (order 2), the same one id (order 1), and the block's majority id (order 0).
Their confidences choose one of 16 adaptive counts that mix the chances of "order
2 is right", "order 1 is right", "order 0 is right" and "none"; the range coder
codes that outcome, and for "none" the id by the file's id frequencies.

Blocks are coded in lockstep: one numpy operation does one step of all of them.
No place is ever out of a table's bounds; "clip" only spares the test.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"TWID\x01\x00"
BLOCK, LEAST_BLOCK, LANES = 4096, 256, 4096
SLOTS2, SLOTS1 = 1 << 9, 1 << 8
CONFIDENT = 3
U = np.uint64
STEP, START_COUNTS = U(24), (4, 4, 2, 6)
FREQUENCY_BITS = 16
LOW_BITS, LEAST_RANGE, WORD = U(48), U(1 << 32), U(16)
LOW_MASK = U((1 << 48) - 1)
ZERO = U(0)


def _pick(second: np.ndarray, first: np.ndarray, zeroth: np.ndarray, of: tuple) -> np.ndarray:
    """By the first order that is right, else the last."""
    return np.where(second, of[0], np.where(first, of[1], np.where(zeroth, of[2], of[3])))


class _Model:
    """Predictions and counts of a number of blocks.

    A prediction is one number: the id times four plus its confidence, which is
    how often in a row it was right.  Counts lie outcome by outcome, and within
    that block by block and context by context.  In a block of at most 4096 ids
    they stay far below what the coder's range can divide.
    """

    def __init__(self, lanes: int):
        self.span = lanes * 16
        self.offsets = (0, self.span, 2 * self.span, 3 * self.span)
        self.tables = (np.zeros(lanes * SLOTS2, np.int32), np.zeros(lanes * SLOTS1, np.int32))
        self.counts = np.repeat(np.array(START_COUNTS, U), self.span)
        self.lanes, lane = lanes, np.arange(lanes)
        self.base2, self.base1, self.base = lane * SLOTS2, lane * SLOTS1, lane * 16
        self.guess0, self.count0 = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.one, self.two = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)

    def shrink(self, lanes: int) -> None:
        self.lanes = lanes
        for name in ("base2", "base1", "base", "guess0", "count0", "one", "two"):
            setattr(self, name, getattr(self, name)[:lanes])

    def predict(self) -> None:
        """Guesses of order 2 and 1 and the running sums of the four outcomes' counts."""
        self.at2 = self.base2 + ((self.two << 5 ^ self.one) & SLOTS2 - 1)
        self.at1 = self.base1 + (self.one & SLOTS1 - 1)
        self.entry2, self.entry1 = self.tables[0].take(self.at2, mode="clip"), self.tables[1].take(self.at1, mode="clip")
        self.trust2, self.trust1 = self.entry2 & 3, self.entry1 & 3
        self.guess2, self.guess1 = self.entry2 >> 2, self.entry1 >> 2
        self.row = self.base + (self.trust2 << 2 | self.trust1)
        counts, row, span = self.counts, self.row, self.span
        # Each outcome's counts are a part of their own, so the same places are taken from all.
        first, one, two, three = (counts[at : at + span].take(row, mode="clip") for at in self.offsets)
        second = first + one
        third = second + two
        self.sums = (first, second, third, third + three)

    def interval(self, right2: np.ndarray, right1: np.ndarray, right0: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower end and size of the outcome's interval; keeps which guesses were right."""
        offset = _pick(right2, right1, right0, self.offsets)
        self.missed = offset == self.offsets[3]
        self.place = self.row + offset
        self.count = self.counts.take(self.place, mode="clip")
        return _pick(right2, right1, right0, (ZERO, *self.sums[:3])), self.count

    def learn(self, ids: np.ndarray, right2: np.ndarray, right1: np.ndarray, right0: np.ndarray) -> None:
        fresh = ids << 2
        self.tables[0][self.at2] = np.where(right2, self.entry2 + (self.trust2 < CONFIDENT), fresh)
        self.tables[1][self.at1] = np.where(right1, self.entry1 + (self.trust1 < CONFIDENT), fresh)
        lost = ~right0
        new = lost & (self.count0 == 0)
        self.count0 = np.where(lost, np.where(new, 1, self.count0 - 1), self.count0 + 1)
        self.guess0 = np.where(new, ids, self.guess0)
        self.counts[self.place] = self.count + STEP
        self.two, self.one = self.one, ids


class _Writer:
    """Range coder state and output words of each block."""

    def __init__(self, lanes: int, words: int):
        self.low, self.range = np.zeros(lanes, U), np.full(lanes, LOW_MASK, U)
        self.words, self.used = np.zeros((lanes, words), np.uint16), np.zeros(lanes, np.int64)

    def code(self, lanes: int, below: np.ndarray, own: np.ndarray, total: np.ndarray | None = None) -> None:
        """Code the interval [below, below + own) of ``total``, 2**FREQUENCY_BITS if not given, in the first ``lanes`` blocks."""
        part = self.range[:lanes] >> U(FREQUENCY_BITS) if total is None else self.range[:lanes] // total
        low = self.low[:lanes] + part * below
        span = part * own
        carry = np.flatnonzero(low > LOW_MASK)
        if len(carry):
            low &= LOW_MASK
            self._carry(carry)
        out = np.flatnonzero(span < LEAST_RANGE)
        if len(out):
            small = low[out]
            self.words[out, self.used[out]] = small >> U(32)
            self.used[out] += 1
            low[out] = small << WORD & LOW_MASK
            span[out] <<= WORD
        self.low[:lanes], self.range[:lanes] = low, span

    def _carry(self, lanes: np.ndarray) -> None:
        place = self.used[lanes] - 1
        while len(lanes):
            self.words[lanes, place] += np.uint16(1)
            over = self.words[lanes, place] == 0
            lanes, place = lanes[over], place[over] - 1

    def finish(self) -> list[bytes]:
        for shift in (32, 16, 0):
            self.words[np.arange(len(self.low)), self.used] = self.low >> U(shift) & U(0xFFFF)
            self.used += 1
        return [self.words[lane, :used].astype("<u2").tobytes() for lane, used in enumerate(self.used)]


class _Reader:
    def __init__(self, blocks: list[bytes]):
        longest = max(len(block) for block in blocks) // 2
        words = np.zeros((len(blocks), longest + 4), np.uint16)
        for lane, block in enumerate(blocks):
            own = np.frombuffer(block, "<u2")
            words[lane, : len(own)] = own
        head = words[:, :3].astype(U)
        self.code = head[:, 0] << U(32) | head[:, 1] << WORD | head[:, 2]
        # The next word of each block, among the words of all blocks in a row, and the last that there is.
        self.words, ends = words.reshape(-1), np.arange(1, len(blocks) + 1) * words.shape[1]
        self.range, self.next, self.last = np.full(len(blocks), LOW_MASK, U), ends - words.shape[1] + 3, ends - 1

    def value(self, lanes: int, total: np.ndarray | None = None) -> np.ndarray:
        self.part = self.range[:lanes] >> U(FREQUENCY_BITS) if total is None else self.range[:lanes] // total
        return np.minimum(self.code[:lanes] // self.part, (U(1 << FREQUENCY_BITS) if total is None else total) - U(1))

    def take(self, lanes: int, below: np.ndarray, own: np.ndarray) -> None:
        code = self.code[:lanes] - self.part * below
        span = self.part * own
        out = np.flatnonzero(span < LEAST_RANGE)
        if len(out):
            place = self.next.take(out)
            code[out] = code.take(out) << WORD | self.words.take(np.minimum(place, self.last.take(out)))
            self.next[out] = place + 1
            span[out] = span.take(out) << WORD
        self.code[:lanes], self.range[:lanes] = code, span


def _frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids that occur, rising, and frequencies of at least 1 that add up to 2**FREQUENCY_BITS."""
    counts = np.bincount(ids)
    known = np.flatnonzero(counts)
    counts = counts[known]
    room = (1 << FREQUENCY_BITS) - len(known)
    if room < 0:
        raise ValueError("more different ids than the coder's frequencies can tell apart")
    share = 1 + counts * room // max(int(counts.sum()), 1)
    if len(share):
        share[counts.argmax()] += (1 << FREQUENCY_BITS) - int(share.sum())
    return known.astype(np.int64), share.astype(np.int64)


def _active(sizes: np.ndarray, step: int) -> int:
    """Blocks, longest first, that have an id at this step."""
    return int(np.searchsorted(-sizes, -step, side="left"))


def block_size(ids: int) -> int:
    return min(BLOCK, max(LEAST_BLOCK, -(-ids // LANES)))


def _intervals(share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower ends and sizes of the ids' intervals, and behind them the whole, which stands for no id."""
    return (np.concatenate(([0], np.cumsum(share)[:-1], [0])).astype(U),
            np.append(share, 1 << FREQUENCY_BITS).astype(U))


def encode_blocks(ids: np.ndarray, known: np.ndarray, share: np.ndarray, block: int) -> list[bytes]:
    lanes = -(-len(ids) // block)
    sizes = np.minimum(block, len(ids) - np.arange(lanes) * block)
    table = np.zeros((lanes, block), np.int32)
    table.reshape(-1)[: len(ids)] = ids
    table = np.ascontiguousarray(table.T)
    below, own_share = _intervals(share)
    number_of = np.zeros(known[-1] + 1, np.int32)
    number_of[known] = np.arange(len(known))
    model, writer = _Model(lanes), _Writer(lanes, 2 * block + 8)
    for step in range(block):
        active = _active(sizes, step)
        if not active:
            break
        if active < model.lanes:
            model.shrink(active)
        own = table[step, :active].astype(np.int64)
        model.predict()
        right = model.guess2 == own, model.guess1 == own, model.guess0 == own
        writer.code(active, *model.interval(*right), model.sums[3])
        number = np.where(model.missed, number_of.take(own, mode="clip"), len(known))
        writer.code(active, below.take(number, mode="clip"), own_share.take(number, mode="clip"))
        model.learn(own, *right)
    return writer.finish()


def decode_blocks(blocks: list[bytes], sizes: np.ndarray, known: np.ndarray, share: np.ndarray) -> list[np.ndarray]:
    """Ids of blocks, which come longest first."""
    below, own_share = _intervals(share)
    number_at = np.repeat(np.arange(len(known), dtype=np.int32), share)
    table = np.zeros((int(sizes[0]), len(blocks)), np.int32)
    model, reader = _Model(len(blocks)), _Reader(blocks)
    for step in range(int(sizes[0])):
        active = _active(sizes, step)
        if active < model.lanes:
            model.shrink(active)
        model.predict()
        first, second, third, total = model.sums
        value = reader.value(active, total)
        chosen = value < first, value < second, value < third
        reader.take(active, *model.interval(*chosen))
        number = number_at.take(reader.value(active).astype(np.int64), mode="clip")
        coded = np.where(model.missed, number, len(known))
        reader.take(active, below.take(coded, mode="clip"), own_share.take(coded, mode="clip"))
        guess = np.where(chosen[0], model.guess2, np.where(chosen[1], model.guess1, model.guess0))
        ids = np.where(model.missed, known.take(number, mode="clip"), guess)
        table[step, :active] = ids
        model.learn(ids, model.guess2 == ids, model.guess1 == ids, model.guess0 == ids)
    # Blocks are read more than once, so their ids come to stand in a row.
    table = np.ascontiguousarray(table.T)
    return [table[lane, :size] for lane, size in enumerate(sizes)]


def _packed(array: np.ndarray) -> bytes:
    data = zlib.compress(np.ascontiguousarray(array, "<i8").tobytes(), 6)
    return struct.pack("<I", len(data)) + data


def write_image(names: list[str | None], sizes: list[int], ids: np.ndarray, block: int | None = None) -> bytes:
    """File image of documents: their names, numbers of ids, and all ids in a row."""
    block = block or block_size(len(ids))
    known, share = _frequencies(ids)
    blocks = encode_blocks(ids, known, share, block) if len(ids) else []
    checks = [zlib.crc32(np.ascontiguousarray(ids[at : at + block], "<u4").tobytes()) for at in range(0, len(ids), block)]
    text = zlib.compress("\n".join("" if name is None else "=" + name.replace("\\", "\\\\").replace("\n", "\\n") for name in names).encode(), 6)
    head = struct.pack("<IQI", len(names), len(ids), block) + struct.pack("<I", len(text)) + text
    head += b"".join(map(_packed, (np.array(sizes), known, share, np.array([len(one) for one in blocks]), np.array(checks))))
    return MAGIC + struct.pack("<II", len(head), zlib.crc32(head)) + head + b"".join(blocks)


class Image:
    """Reader of a file image; damage raises ValueError."""

    def __init__(self, data: bytes):
        if data[: len(MAGIC)] != MAGIC:
            raise ValueError("not a file of token ids")
        at = len(MAGIC) + 8
        size, check = struct.unpack("<II", data[len(MAGIC) : at])
        head = data[at : at + size]
        if zlib.crc32(head) != check:
            raise ValueError("header is damaged")
        documents, self.n_ids, self.block = struct.unpack("<IQI", head[:16])
        length = struct.unpack("<I", head[16:20])[0]
        names = zlib.decompress(head[20 : 20 + length]).decode().split("\n") if documents else []
        unescaped = lambda name: name.replace("\\\\", "\0").replace("\\n", "\n").replace("\0", "\\")
        self.names = [unescaped(name[1:]) if name else None for name in names]
        place, arrays = 20 + length, []
        for _ in range(5):
            length = struct.unpack("<I", head[place : place + 4])[0]
            arrays.append(np.frombuffer(zlib.decompress(head[place + 4 : place + 4 + length]), "<i8"))
            place += 4 + length
        self.sizes, self.known, self.share, lengths, self.checks = arrays
        self.ends = at + size + np.cumsum(lengths)
        self.lengths, self.data = lengths, data

    def blocks(self, numbers: list[int]) -> list[np.ndarray]:
        """Ids of the given blocks, each decoded by itself and verified."""
        if not numbers:
            return []
        sizes = np.array([min(self.block, self.n_ids - number * self.block) for number in numbers], np.int64)
        order = np.argsort(-sizes, kind="stable")
        coded = [self.data[self.ends[number] - self.lengths[number] : self.ends[number]] for number in numbers]
        found: list[np.ndarray] = [np.zeros(0, np.int32)] * len(numbers)
        for lane, ids in zip(order, decode_blocks([coded[place] for place in order], sizes[order], self.known, self.share)):
            if zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes()) != self.checks[numbers[lane]]:
                raise ValueError(f"block {numbers[lane]} is damaged")
            found[lane] = ids
        return found

    def ids(self) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.int32), *self.blocks(list(range(len(self.lengths))))])
