"""Hard negatives against plain loops over all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm import hard_negatives
from tabwright.llm.threshold_index import Block

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, is_anchor, scale=256, positives=5, negatives=5, ratio=(80, 100)):
    sound = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        sound.append((vec_id, [math.floor(scale * float(np.float32(x))) for x in vector], label))
    out = []
    for at, (anchor_id, anchor, label) in enumerate(sound):
        if not is_anchor(anchor_id):
            continue
        scored = [(-sum(x * y for x, y in zip(anchor, vector)), vec_id, other) for place, (vec_id, vector, other) in enumerate(sound) if place != at]
        own = sorted((score, vec_id) for score, vec_id, other in scored if other == label)[:positives]
        rest = sorted((score, vec_id) for score, vec_id, other in scored if other != label)
        for score, positive_id in own:
            fits = [one for one in rest if ratio[0] * -score <= ratio[1] * -one[0] <= ratio[1] * -score][:negatives]
            out += [(anchor_id, positive_id, rank, vec_id, -score, -found) for rank, (found, vec_id) in enumerate(fits, start=1)]
    return sorted(out)


def made(count, seed, width=20, labels=3):
    pick = random.Random(seed)
    centres = [[pick.gauss(0, 0.25) for _ in range(width)] for _ in range(4)]
    rows = []
    for place in range(count):
        centre = centres[place % 4]
        rows.append((place, [x + pick.gauss(0, 0.12) for x in centre], pick.randrange(labels)))
    return rows


def run(spark, rows, every, **named):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(row) for row in hard_negatives.mine(df, F.col("vec_id") % every == 0, **named).collect())


@pytest.mark.parametrize("blocks", [1, 5])
def test_against_plain_loops(spark, monkeypatch, blocks):
    monkeypatch.setattr(hard_negatives, "blocks_of", lambda rows: blocks)
    monkeypatch.setattr(hard_negatives, "TOGETHER", 7)
    rows = made(300, 1)
    found = run(spark, rows, 9)
    assert found == plain(rows, lambda one: one % 9 == 0) and len(found) > 300
    other = run(spark, rows, 20, scale=40, positives=3, negatives=2, ratio=(60, 90))
    assert other == [] or other == plain(rows, lambda one: one % 20 == 0, 40, 3, 2, (60, 90))


def test_copies_ties_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "blocks_of", lambda rows: 3)
    rows = made(60, 2)
    # A hot vector with two labels, repeated rows and ids, rows that take no part, other lengths.
    rows += [(1000 + place, [0.3] * 20, place % 2) for place in range(60)]
    rows += [(0, [0.3] * 20, 1), (0, [0.3] * 20, 1), (9, [0.3] * 20, 0)]
    rows += [(None, [0.1] * 20, 1), (2000, None, 1), (2010, [0.1] * 20, None), (2020, [0.1, None], 1), (2030, [float("nan")], 1), (2040, [float("inf")], 0)]
    rows += [(3000, [], 1), (3001, [0.3], 1), (3010, [0.3] * 25, 0), (3020, [-0.4] * 20, 2), (3021, [0.4] * 20, 2)]
    assert run(spark, rows, 10) == plain(rows, lambda one: one % 10 == 0)


def test_empty_without_anchors_and_clashing_columns(spark):
    assert run(spark, [], 10) == []
    assert run(spark, [(1, [0.5], 1)], 10) == []
    rows = made(80, 3)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"q": F.lit(1), "id": F.lit("x"), "vec": F.lit(2), "_anchor": F.lit(3), "rank": F.lit(4)})
    assert sorted(map(tuple, hard_negatives.mine(df, F.col("vec_id") % 8 == 0).collect())) == plain(rows, lambda one: one % 8 == 0)


def test_large_components_are_exact(spark):
    pick = random.Random(4)
    rows = [(place, [float(pick.randrange(1 << 20)) for _ in range(6)], place % 2) for place in range(40)]
    assert run(spark, rows, 5) == plain(rows, lambda one: one % 5 == 0)


@pytest.mark.parametrize("scale", [30, 3000, 10**9])
def test_index_finds_every_pair_at_its_threshold(scale):
    random_ = np.random.default_rng(scale)
    rows = random_.integers(-scale, scale, (500, 70)) * random_.choice([0, 1], (500, 70))
    asked = random_.integers(-scale, scale, (9, 64))
    block = Block(np.arange(500), np.zeros(500, np.int64), rows)
    inside, tails = block.queries(asked)
    exact = np.array([[sum(int(x) * int(y) for x, y in zip(one, row)) for row in rows] for one in asked], dtype=object)
    for share in (0.999, 0.9, 0.5, 0.05):
        thresholds = np.array([float(sorted(scores)[int(share * 499)]) for scores in exact])
        query, row, score = block.at_least(inside, tails, thresholds)
        want = {(q, r): exact[q][r] for q in range(9) for r in range(500) if exact[q][r] >= thresholds[q]}
        assert {(q, r): s for q, r, s in zip(query.tolist(), row.tolist(), score.tolist())} == want
