"""Threshold joins of integer vectors inside one block, after the ideas of L2AP.

A block keeps its rows whole (the forward store) and builds, for a batch of
queries and the lowest of their thresholds, an inverted index by dimension.  The
dimensions stand in chunks, heaviest first.  A row's last chunks are left out of
the index where the norm of what is left out, times the largest such norm of the
queries, stays below the threshold: a pair that shares only these dimensions
cannot reach it.  Scores are accumulated chunk by chunk; a row is dropped when
its partial score and the norms of what remains stay below every query's
threshold.  Pairs that are left get their exact score from the forward store.

All arithmetic is exact: the product of the largest norms bounds every partial
sum, and it chooses 32-bit or 64-bit floats (both hold such whole numbers), or
Python's integers beyond them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK = 16
# A query's threshold falls from the top of its lowest window to the bottom in so many steps.
STEPS = 4
# Pairs whose forward vectors are multiplied at a time.
PAIRS = 100_000


def padded(flat: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """Ragged rows as a matrix; a shorter vector counts as followed by zeros."""
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def exact_type(most: float) -> type:
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else object


class Block:
    """Rows (id, label, vector) of one block, and the answers to batches of queries."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        heavy = np.argsort(-(vectors.astype(np.float64) ** 2).sum(axis=0), kind="stable")
        self.ids, self.labels, self.heavy = ids, labels, heavy
        self.borders = np.arange(0, max(len(heavy), 1), CHUNK)
        self.vectors = vectors[:, heavy]
        self.tails = self._tails(self.vectors)

    def _tails(self, vectors: np.ndarray) -> np.ndarray:
        """Norm of each row from every chunk on; 0 behind the last."""
        if not vectors.shape[1]:
            return np.zeros((len(vectors), 2))
        squares = np.add.reduceat(vectors.astype(np.float64) ** 2, self.borders, axis=1)
        tails = np.sqrt(np.cumsum(squares[:, ::-1], axis=1)[:, ::-1])
        return np.hstack([tails, np.zeros((len(vectors), 1))])

    def queries(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Query vectors in the block's order of dimensions, and the norms of their tails.

        A query may have more dimensions than any row of the block: they meet zeros only.
        """
        width = len(self.heavy)
        if vectors.shape[1] < width:
            vectors = np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))
        inside = vectors[:, self.heavy]
        return inside, self._tails(inside)

    def at_least(self, vectors: np.ndarray, tails: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, ...]:
        """(query, row, score) of all pairs whose score reaches the query's threshold, by query."""
        most = float(tails[:, 0].max() * self.tails[:, 0].max()) * (1 + 1e-9) + 1
        kind, slack, chunks = exact_type(most), most * 1e-9 + 1e-6, len(self.borders)
        floors = thresholds - slack
        # Chunks a row has in the index: those from which on it could still reach the lowest threshold.
        indexed = np.minimum((self.tails * tails.max(axis=0) >= floors.min()).sum(axis=1), chunks)
        rows = np.argsort(-indexed, kind="stable")[: int((indexed > 0).sum())]
        asked, postings = vectors.astype(kind), self.vectors[rows].astype(kind)
        partial = np.zeros((len(vectors), len(rows)), kind)
        for chunk, start in enumerate(self.borders):
            held = int((indexed[rows] > chunk).sum())
            if not held:
                break
            part = slice(start, start + CHUNK)
            partial[:, :held] += asked[:, part] @ postings[:held, part].T
            # What is left of a row meets at most the query's norm from the same chunk on.
            border = np.minimum(chunk + 1, indexed[rows])
            left = tails[:, border] * self.tails[rows, border][None, :]
            alive = (partial.astype(np.float64) + left >= floors[:, None]).any(axis=0)
            if not alive.all():
                rows, postings, partial = rows[alive], postings[alive], partial[:, alive]
        rest = tails[:, indexed[rows]] * self.tails[rows, indexed[rows]][None, :]
        query, place = np.nonzero(partial.astype(np.float64) + rest >= floors[:, None])
        score = np.array(partial[query, place])
        open_ = np.flatnonzero(indexed[rows][place] < chunks)
        for start in range(0, len(open_), PAIRS):
            some = open_[start : start + PAIRS]
            score[some] = (asked[query[some]] * postings[place[some]]).sum(axis=1)
        score = score.astype(np.int64)
        reached = score >= thresholds[query]
        return query[reached], rows[place[reached]], score[reached]

    def windows(
        self, vectors: np.ndarray, labels: np.ndarray, tops: list[np.ndarray], lows: list[np.ndarray],
        need: int, same: bool,
    ) -> Iterator[tuple[int, int, int, int]]:
        """(query, top, id, score): the first ``need`` rows of each window [low, top] of each query.

        Rows have the query's label if ``same``, another one if not; higher scores
        come first, ties by smaller id.  Each query starts with a high threshold,
        which is lowered until its windows are full or their bottom is reached.
        """
        inside, tails = self.queries(vectors)
        reach = np.floor(tails[:, 0] * self.tails[:, 0].max() * (1 + 1e-9) + 1)
        high = np.array([min(float(top.min()), far) if len(top) else 0.0 for top, far in zip(tops, reach)])
        bottom = np.array([max(float(low.min()), -far) if len(low) else 1.0 for low, far in zip(lows, reach)])
        # Rounding may only lower a bottom; the windows are cut by their exact ends.
        bottom -= np.abs(bottom) * 1e-15
        # A window that begins above what the block can reach stays empty, as one without a value does.
        open_ = np.flatnonzero(bottom <= high)
        for step in range(1, STEPS + 1):
            if not len(open_):
                return
            last = step == STEPS
            thresholds = bottom[open_] if last else np.ceil(high[open_] - (high[open_] - bottom[open_]) * step / STEPS)
            query, row, score = self.at_least(inside[open_], tails[open_], thresholds)
            fits = (self.labels[row] == labels[open_][query]) == same
            query, row, score = query[fits], row[fits], score[fits]
            order = np.lexsort((self.ids[row], -score, query))
            query, row, score = query[order], row[order], score[order]
            ends = np.searchsorted(query, np.arange(len(open_) + 1))
            kept = []
            for at, asked in enumerate(open_):
                mine = score[ends[at] : ends[at + 1]]
                first = np.searchsorted(-mine, -tops[asked], side="left")
                after = np.minimum(np.searchsorted(-mine, -lows[asked], side="right"), first + need)
                if not last and np.any((after - first < need) & (thresholds[at] > lows[asked])):
                    kept.append(asked)
                    continue
                for top, begin, end in zip(tops[asked], first, after):
                    for place in range(ends[at] + begin, ends[at] + end):
                        yield int(asked), int(top), int(self.ids[row[place]]), int(score[place])
            open_ = np.array(kept, np.int64)
