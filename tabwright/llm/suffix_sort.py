"""Two-stage suffix sorting of one bounded piece of bytes, in numpy."""

from __future__ import annotations

import numpy as np


def suffix_array(text: bytes, depth: int) -> np.ndarray:
    """Start places of all suffixes in the order of their first ``depth`` bytes (at least).

    Suffixes smaller than their successor are sorted directly.  The others, in
    each bucket of one first byte, come before those and are induced: a scan
    over the buckets in order meets every successor before its predecessor's
    place is due, so a predecessor goes to the next free place of its bucket.
    """
    size = len(text)
    codes = np.frombuffer(text, np.uint8).astype(np.int64)
    if size < 2:
        return np.arange(size)
    # A suffix is smaller than its successor if the next other byte is larger; the last suffix is not.
    rises = np.sign(codes[1:] - codes[:-1])
    place = np.arange(size - 1)
    change = np.where(rises != 0, place, size)
    following = np.minimum.accumulate(np.append(change, size)[::-1])[::-1][:-1]
    smaller = np.zeros(size, bool)
    known = following < size
    smaller[:-1][known] = rises[following[known]] > 0

    counts = np.bincount(codes, minlength=256)
    induced = np.bincount(codes[~smaller], minlength=256)
    starts = np.concatenate(([0], np.cumsum(counts)))
    order = np.empty(size, np.int64)
    direct = np.nonzero(smaller)[0].tolist()
    direct.sort(key=lambda at: text[at : at + depth])
    direct = np.array(direct, np.int64)
    first = codes[direct]
    within = np.arange(len(direct)) - np.concatenate(([0], np.cumsum(np.bincount(first, minlength=256))))[first]
    order[starts[first] + induced[first] + within] = direct

    head = starts[:-1].copy()

    def induce(scanned: np.ndarray) -> None:
        before = scanned[scanned > 0] - 1
        before = before[~smaller[before]]
        if not len(before):
            return
        byte = codes[before]
        by_byte = np.argsort(byte, kind="stable")
        byte = byte[by_byte]
        number = np.bincount(byte, minlength=256)
        offset = np.arange(len(byte)) - (np.cumsum(number) - number)[byte]
        order[head[byte] + offset] = before[by_byte]
        head[:] += number

    induce(np.array([size]))
    for byte in np.nonzero(counts)[0]:
        low = starts[byte]
        while low < head[byte]:
            low, high = head[byte], low
            induce(order[high:low])
        induce(order[starts[byte] + induced[byte] : starts[byte + 1]])
    return order


def common_prefixes(text: bytes, places: np.ndarray, depth: int) -> np.ndarray:
    """For each two neighbours in ``places``: bytes they have in common, ``depth`` at most."""
    codes = np.concatenate((np.frombuffer(text, np.uint8), np.zeros(depth + 8, np.uint8)))
    one, two = places[:-1], places[1:]
    limit = np.minimum(np.minimum(len(text) - one, len(text) - two), depth)
    common = np.zeros(len(one), np.int64)
    alive = np.nonzero(limit > 0)[0]
    step = 8
    words = np.lib.stride_tricks.sliding_window_view(codes, step)
    while len(alive):
        at = common[alive]
        same = words[one[alive] + at] == words[two[alive] + at]
        run = np.where(same.all(axis=1), step, same.argmin(axis=1))
        common[alive] = at + run
        alive = alive[(run == step) & (common[alive] < limit[alive])]
    return np.minimum(common, limit)
