"""A small causal self-attention model over token ids, in numpy: training, and scoring with overlapping windows.

One layer of masked attention over embeddings of the last ``window`` ids predicts
the class of the next id, first its group and then the class within the group;
within a class ids keep their training frequencies.
Frequent ids are classes of their own, the others share classes by frequency.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WINDOW, STRIDE = 32, 16
WIDTH = 16
CLASSES, SINGLE = 512, 448
# Classes stand in groups: a class's chance is its group's times its own within the group.
GROUPS = 16
MEMBERS = CLASSES // GROUPS
INPUTS = 8192
RATE, BATCH = 4e-3, 64
# Windows scored at once, so that their logits stay near the cache.
TOGETHER = 128
# Scores beyond this are cut before they are raised to powers of e.
MOST_SCORE = np.float32(80)


@dataclass
class Vocabulary:
    """Class and input number of each id, and the log10 share of an id in its class."""

    class_of: np.ndarray
    input_of: np.ndarray
    log_share: np.ndarray
    class_log: np.ndarray       # natural log of each class's share

    @classmethod
    def from_counts(cls, counts: np.ndarray) -> Vocabulary:
        weight = counts + 0.5
        order = np.lexsort((np.arange(len(counts)), -counts))
        rank = np.empty(len(counts), np.int64)
        rank[order] = np.arange(len(counts))
        # What is not a class of its own is cut where the running share of the rest passes equal parts.
        rest = weight[order[SINGLE:]]
        shared = CLASSES - SINGLE
        part = np.minimum((np.cumsum(rest) - rest / 2) / rest.sum() * shared, shared - 1).astype(np.int64) if len(rest) else rest.astype(np.int64)
        by_rank = np.concatenate((np.arange(min(SINGLE, len(counts))), SINGLE + part))
        class_of = by_rank[rank]
        mass = np.bincount(class_of, weight, CLASSES)
        return cls(class_of.astype(np.int32), np.minimum(rank, INPUTS - 1).astype(np.int32),
                   np.log10(weight / mass[class_of]).astype(np.float32), np.log((mass + 1e-9) / mass.sum()).astype(np.float32))


def fresh(vocabulary: Vocabulary, seed: int = 11) -> dict[str, np.ndarray]:
    """Small random weights; the last rows of group and head are biases and start at the shares of groups and classes."""
    random = np.random.default_rng(seed)
    shapes = {"embed": (INPUTS, WIDTH), "place": (WINDOW, WIDTH), "query": (WIDTH, WIDTH), "key": (WIDTH, WIDTH),
              "value": (WIDTH, WIDTH), "out": (WIDTH, WIDTH), "head": (WIDTH, CLASSES), "group": (WIDTH, GROUPS)}
    weights = {name: (random.standard_normal(shape) * (0.5 if name == "embed" else 0.2)).astype(np.float32) for name, shape in shapes.items()}
    of_groups = np.log(np.exp(vocabulary.class_log.astype(np.float64)).reshape(GROUPS, MEMBERS).sum(axis=1)).astype(np.float32)
    return weights | {"head": np.vstack([weights["head"], vocabulary.class_log]), "group": np.vstack([weights["group"], of_groups])}


_EARLIER = np.tril(np.ones((WINDOW, WINDOW), np.float32))
_SCALE = np.float32(1 / np.sqrt(WIDTH))


def _forward(weights: dict[str, np.ndarray], inputs: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Hidden states of (windows, places), and what the way back needs; attention comes as powers of e and their sums."""
    windows, places = inputs.shape
    x = weights["embed"].take(inputs, axis=0)
    x += weights["place"][:places]
    three = x.reshape(-1, WIDTH) @ np.hstack([weights["query"] * _SCALE, weights["key"], weights["value"]])
    q, k, v = np.split(three.reshape(windows, places, 3 * WIDTH), 3, axis=2)
    power = q @ k.transpose(0, 2, 1)
    np.clip(power, -MOST_SCORE, MOST_SCORE, out=power)
    np.exp(power, out=power)
    power *= _EARLIER[:places, :places]
    sums = (power.reshape(-1, places) @ np.ones(places, power.dtype)).reshape(windows, places, 1)
    mixed = power @ v
    mixed /= sums
    hidden = (mixed.reshape(-1, WIDTH) @ weights["out"]).reshape(x.shape)
    hidden += x
    return hidden, (x, q, k, v, power, sums, mixed)


def _with_one(hidden: np.ndarray) -> np.ndarray:
    """Rows with a one at their end, for the biases."""
    out = np.ones((len(hidden), WIDTH + 1), hidden.dtype)
    out[:, :WIDTH] = hidden
    return out


def _down(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """first.T @ second, in pieces that stay in the cache."""
    if len(first) % 256:
        return first.T @ second
    pieces = first.reshape(-1, 256, first.shape[1]).transpose(0, 2, 1) @ second.reshape(-1, 256, second.shape[1])
    return pieces.sum(axis=0)


def _powers(logits: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The targets' logits; logits become powers of e, whose sums come with them."""
    np.clip(logits, -MOST_SCORE, MOST_SCORE, out=logits)
    own = logits.reshape(-1).take(np.arange(0, logits.size, logits.shape[1]) + targets)
    np.exp(logits, out=logits)
    return own, logits @ np.ones(logits.shape[1], logits.dtype)


def _by_group(targets: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Order of the targets by group, and (group, first, last) of the runs."""
    groups = (targets // MEMBERS).astype(np.uint8)
    ends = np.cumsum(np.bincount(groups, minlength=GROUPS)).tolist()
    return np.argsort(groups, kind="stable"), [run for run in zip(range(GROUPS), [0, *ends], ends) if run[1] < run[2]]


def _member_logits(weights: dict[str, np.ndarray], hidden: np.ndarray, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Logits of the classes of each row's group; rows stand by group."""
    logits = np.empty((len(hidden), MEMBERS), hidden.dtype)
    for group, first, last in runs:
        own = slice(group * MEMBERS, (group + 1) * MEMBERS)
        np.matmul(hidden[first:last], weights["head"][:, own], out=logits[first:last])
    return logits


def _class_log(weights: dict[str, np.ndarray], hidden: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural log of the targets' class chances; hidden is (rows, WIDTH)."""
    hidden = _with_one(hidden)
    own, sums = _powers(hidden @ weights["group"], targets // MEMBERS)
    found = own - np.log(sums)
    order, runs = _by_group(targets)
    own, sums = _powers(_member_logits(weights, hidden.take(order, axis=0), runs), targets.take(order) % MEMBERS)
    found[order] += own - np.log(sums)
    return found


def _chances_less_target(logits: np.ndarray, targets: np.ndarray, rows: int) -> np.ndarray:
    """Slope of the mean loss by the logits, in their place."""
    _, sums = _powers(logits, targets)
    logits *= (1 / (sums * rows))[:, None]
    logits.reshape(-1)[np.arange(0, logits.size, logits.shape[1]) + targets] -= logits.dtype.type(1 / rows)
    return logits


def _slopes(weights: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Slopes of the mean loss by all weights but the embedding, and by the embedded inputs."""
    hidden, (x, q, k, v, power, sums, mixed) = _forward(weights, inputs)
    flat, targets = _with_one(hidden.reshape(-1, WIDTH)), targets.reshape(-1)
    logits = _chances_less_target(flat @ weights["group"], targets // MEMBERS, len(flat))
    found = {"group": _down(flat, logits), "head": np.zeros_like(weights["head"])}
    to_hidden = logits @ weights["group"][:WIDTH].T
    order, runs = _by_group(targets)
    flat = flat.take(order, axis=0)
    logits = _chances_less_target(_member_logits(weights, flat, runs), targets.take(order) % MEMBERS, len(flat))
    back = np.empty_like(to_hidden)
    for group, first, last in runs:
        own = slice(group * MEMBERS, (group + 1) * MEMBERS)
        np.matmul(flat[first:last].T, logits[first:last], out=found["head"][:, own])
        np.matmul(logits[first:last], weights["head"][:WIDTH, own].T, out=back[first:last])
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    to_hidden += back.take(place, axis=0)
    found["out"] = _down(mixed.reshape(-1, WIDTH), to_hidden)
    to_mixed = (to_hidden @ weights["out"].T).reshape(x.shape)
    to_mixed /= sums
    less = np.einsum("wpi,wpi->wp", to_mixed, mixed)[:, :, None]
    to_three = np.empty((*inputs.shape, 3 * WIDTH), x.dtype)
    np.matmul(power.transpose(0, 2, 1), to_mixed, out=to_three[:, :, 2 * WIDTH :])
    to_raw = to_mixed @ v.transpose(0, 2, 1)
    to_raw -= less
    to_raw *= power
    np.matmul(to_raw, k, out=to_three[:, :, :WIDTH])
    np.matmul(to_raw.transpose(0, 2, 1), q, out=to_three[:, :, WIDTH : 2 * WIDTH])
    to_three = to_three.reshape(-1, 3 * WIDTH)
    found |= zip(("query", "key", "value"), np.split(_down(x.reshape(-1, WIDTH), to_three), 3, axis=1))
    found["query"] = found["query"] * _SCALE
    to_x = to_three @ np.hstack([weights["query"] * _SCALE, weights["key"], weights["value"]]).T
    to_x += to_hidden
    found["place"] = np.zeros_like(weights["place"])
    found["place"][: x.shape[1]] = to_x.reshape(x.shape).sum(axis=0)
    return found, to_x


def _sums_by_row(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different rows, rising, and the sums of their values."""
    order = np.argsort(rows, kind="stable")
    rows = rows.take(order)
    starts = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
    return rows.take(starts), np.add.reduceat(values.take(order, axis=0), starts, axis=0)


def _gradients(weights: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray) -> dict[str, np.ndarray]:
    found, to_x = _slopes(weights, inputs, targets)
    found["embed"] = np.zeros_like(weights["embed"])
    rows, sums = _sums_by_row(inputs.reshape(-1), to_x)
    found["embed"][rows] = sums
    return found


class Trainer:
    """Adam over batches of windows of WINDOW + 1 ids each, as they come; an embedding moves when its id is seen."""

    def __init__(self, weights: dict[str, np.ndarray], vocabulary: Vocabulary, rate: float = RATE) -> None:
        # All weights but the embedding are views of one row of numbers, so that one operation moves them.
        others = {name: value for name, value in weights.items() if name != "embed"}
        self.flat = np.concatenate([value.ravel() for value in others.values()])
        cuts = np.cumsum([value.size for value in others.values()])[:-1]
        self.weights = {name: piece.reshape(value.shape) for (name, value), piece in zip(others.items(), np.split(self.flat, cuts))}
        self.names = list(others)
        self.weights["embed"] = weights["embed"].copy()
        self.first, self.second = np.zeros_like(self.flat), np.zeros_like(self.flat)
        self.embed_first, self.embed_second = np.zeros_like(weights["embed"]), np.zeros_like(weights["embed"])
        self.vocabulary, self.rate, self.step = vocabulary, rate, 0

    def _move(self, first: np.ndarray, second: np.ndarray, slope: np.ndarray) -> np.ndarray:
        """New moments in place of the old, and the way to go."""
        whole, part = 1 - 0.9**self.step, 1 - 0.99**self.step
        first += 0.1 * (slope - first)
        second += 0.01 * (slope * slope - second)
        return (self.rate / whole) * first / (np.sqrt(second * (1 / part)) + 1e-8)

    def feed(self, windows: np.ndarray) -> None:
        """One pass over the windows."""
        inputs, targets = self.vocabulary.input_of.take(windows[:, :-1]), self.vocabulary.class_of.take(windows[:, 1:])
        inputs = inputs.astype(np.uint16)
        for at in range(0, len(windows), BATCH):
            self.step += 1
            own = inputs[at : at + BATCH]
            found, to_x = _slopes(self.weights, own, targets[at : at + BATCH])
            self.flat -= self._move(self.first, self.second, np.concatenate([found[name].ravel() for name in self.names]))
            rows, slope = _sums_by_row(own.reshape(-1), to_x)
            first, second = self.embed_first.take(rows, axis=0), self.embed_second.take(rows, axis=0)
            self.weights["embed"][rows] -= self._move(first, second, slope)
            self.embed_first[rows], self.embed_second[rows] = first, second


def train(weights: dict[str, np.ndarray], vocabulary: Vocabulary, windows: np.ndarray, rate: float = RATE) -> dict[str, np.ndarray]:
    """One pass of Adam over windows of WINDOW + 1 ids each."""
    trainer = Trainer(weights, vocabulary, rate)
    trainer.feed(windows)
    return trainer.weights


def training_windows(ids: np.ndarray, end_id: int) -> np.ndarray:
    """Back-to-back windows of WINDOW + 1 ids in which every id of a text is a target once.

    The end id stands before the text and fills up the last window; each window's first id is the last of the one before.
    """
    count = -(-len(ids) // WINDOW)
    flat = np.full(count * WINDOW + 1, end_id, np.int32)
    flat[1 : len(ids) + 1] = ids
    return np.lib.stride_tricks.sliding_window_view(flat, WINDOW + 1)[::WINDOW]


def window_plan(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first place, first scored place) of the windows that score every place of every text once.

    A text's first window scores all its places; each later one starts STRIDE
    further and scores its last STRIDE places, which see WINDOW - STRIDE earlier ones at least.
    """
    further = np.maximum(0, -(-(sizes - WINDOW) // STRIDE))
    count = np.where(sizes > 0, 1 + further, 0)
    text = np.repeat(np.arange(len(sizes)), count)
    number = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    start = number * STRIDE
    return text, start, np.where(number == 0, 0, start + WINDOW - STRIDE)


@dataclass
class Scorer:
    """Weights laid out for scoring: query (scaled), key and value side by side."""

    weights: dict[str, np.ndarray]

    def __post_init__(self) -> None:
        self.three = np.hstack([self.weights["query"] * _SCALE, self.weights["key"], self.weights["value"]])

    def class_logs(self, inputs: np.ndarray, classes: np.ndarray, since: int) -> np.ndarray:
        """Natural log chances of the classes at places ``since`` and later; inputs are (windows, places)."""
        windows, places = inputs.shape
        x = self.weights["embed"].take(inputs, axis=0)
        x += self.weights["place"][:places]
        three = (x.reshape(-1, WIDTH) @ self.three).reshape(windows, places, 3 * WIDTH)
        power = three[:, since:, :WIDTH] @ three[:, :, WIDTH : 2 * WIDTH].transpose(0, 2, 1)
        np.clip(power, -MOST_SCORE, MOST_SCORE, out=power)
        np.exp(power, out=power)
        power *= _EARLIER[since:places, :places]
        mixed = power @ three[:, :, 2 * WIDTH :]
        mixed /= (power.reshape(-1, places) @ np.ones(places, power.dtype)).reshape(windows, -1, 1)
        hidden = mixed.reshape(-1, WIDTH) @ self.weights["out"]
        hidden += x[:, since:].reshape(-1, WIDTH)
        return _class_log(self.weights, hidden, classes.reshape(-1))


def score_texts(scorer: Scorer, vocabulary: Vocabulary, ids: np.ndarray, sizes: np.ndarray, end_id: int) -> np.ndarray:
    """log10 chance of each text: ``ids`` of all texts in a row, ``sizes`` of them each.  The end id stands before a text."""
    begins = np.cumsum(sizes) - sizes
    before = np.empty(len(ids), np.int32)
    before[1:] = ids[:-1]
    before[begins[sizes > 0]] = end_id
    inputs, classes = vocabulary.input_of.take(before), vocabulary.class_of.take(ids)
    logs = np.zeros(len(ids), np.float32)
    text, start, _ = window_plan(sizes)
    # Windows of one kind go together: first or later ones, whole or ended by their text.
    length = np.minimum(sizes[text] - start, WINDOW)
    kind = 2 * length + (start > 0)
    order = np.argsort(kind, kind="stable")
    edges = np.flatnonzero(np.diff(kind[order], prepend=-1, append=-1))
    for first, last in zip(edges[:-1], edges[1:]):
        since = WINDOW - STRIDE if kind[order[first]] % 2 else 0
        for at in range(first, last, TOGETHER):
            part = order[at : min(at + TOGETHER, last)]
            places = (begins[text[part]] + start[part])[:, None] + np.arange(kind[order[first]] // 2)
            scored = places[:, since:]
            logs[scored.reshape(-1)] = scorer.class_logs(inputs.take(places), classes.take(scored), since)
    chances = logs.astype(np.float64) / np.log(10) + vocabulary.log_share.take(ids)
    sums = np.concatenate(([0.0], np.cumsum(chances)))
    return sums[begins + sizes] - sums[begins]
