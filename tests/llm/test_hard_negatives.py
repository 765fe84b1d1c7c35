import math
import random

import numpy as np
import pytest

from tidemark.llm import hard_negatives
from tidemark.llm.hard_negatives import (
    NegativeRules,
    _top,
    bit_planes,
    low_bounds,
    mine_negatives,
    scores,
    subset_sums,
)

SCHEMA = "vec_id long, embedding array<double>, label int, row_id long, q int, bounds string"


def frame(spark, rows):
    return spark.createDataFrame([(*row, 1, 2, "b") for row in rows], SCHEMA).repartition(4)


def brute_force(rows, rules=NegativeRules()):
    usable = []
    for number, (vec_id, vector, label) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        usable.append((number, vec_id, label, [math.floor(256 * x) for x in vector]))
    found = []
    for number, anchor, label, q in usable:
        if anchor is None or anchor % rules.every:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(q, other)), vec_id is None, vec_id or 0, kind)
            for n, vec_id, kind, other in usable
            if n != number and len(other) == len(q)
        )
        positives = [s for s in scored if s[3] == label][: rules.positives]
        for high, gone, positive, _ in positives:
            negatives = [
                s for s in scored
                if s[3] != label and -rules.low_percent * high <= -100 * s[0] <= -100 * high
            ][: rules.negatives]
            for rank, (score, lost, negative, _) in enumerate(negatives):
                found.append(
                    (anchor, None if gone else positive, rank + 1, None if lost else negative, -high, -score)
                )
    return sorted(found, key=str)


def table(seed, count=400, dims=12):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(3)]
    rows = []
    for i in range(count):
        vector = [c + rng.gauss(0, 0.2) for c in rng.choice(centres)]
        rows.append((i * 5, vector, rng.randrange(4)))
    hot = [0.5] * dims
    rows += [(10_000 + i, hot, rng.randrange(4)) for i in range(300)]
    rows += [
        (None, hot, 1), (None, hot, 2), (20_000, hot, 3), (20_000, hot, 3), (20_100, None, 1),
        (20_200, [], 1), (20_300, [float("nan")] * dims, 1), (20_400, [None] * dims, 1),
        (20_500, hot, None), (20_600, [1e4, -3.5], 1), (20_601, [1e4, 2.5], 1),
        (20_602, [9.9e3, 0.0], 2), (-100, [-x for x in hot], 2), (20_700, [0.0] * dims, 1),
    ]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_brute_force(spark, seed):
    rows = table(seed)
    found = sorted(map(tuple, mine_negatives(frame(spark, rows)).collect()), key=str)
    assert found == brute_force(rows) and found


def test_several_chunks_of_anchors(spark):
    rows = table(3)
    rules = NegativeRules(every=20, chunk=7)
    found = sorted(map(tuple, mine_negatives(frame(spark, rows), rules).collect()), key=str)
    assert found == brute_force(rows, rules)


def test_vectors_beyond_exact_scores_take_no_part(spark):
    rows = [(100, [1.0], 1), (1, [1e300], 1), (2, [1.0], 1), (3, [0.9], 2), (4, [-1e300], 2)]
    found = mine_negatives(frame(spark, rows)).collect()
    assert [tuple(r) for r in found] == [(100, 2, 1, 3, 256 * 256, 256 * 230)]


def test_empty_table(spark):
    found = mine_negatives(frame(spark, []))
    assert found.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score",
    ]
    assert found.count() == 0


@pytest.mark.parametrize("low, high, dims", [(-256, 256, 64), (0, 0, 8), (-9, -1, 13), (-(2**24), 2**24, 5), (3, 900, 1)])
def test_lookups_give_inner_products(low, high, dims):
    rng = np.random.default_rng(1)
    candidates = rng.integers(low, high + 1, (50, dims))
    anchors = rng.integers(low, high + 1, (9, dims))
    expected = candidates @ anchors.T
    assert (scores(subset_sums(anchors), bit_planes(candidates)) == expected).all()


def test_top_takes_ties_in_order():
    found = np.array([[5, 5, 5, 5, 7, 1], [1, 2, 3, 4, 5, 6]] * 2)
    allowed = np.ones(found.shape, bool)
    allowed[1, 5] = False
    anchor, row = _top(np.repeat(found, 10, axis=1), np.repeat(allowed, 10, axis=1), 3)
    assert row[anchor == 0].tolist() == [40, 41, 42]
    assert row[anchor == 1].tolist() == [40, 41, 42]
    found[0, 4] = 5
    anchor, row = _top(found, allowed, 2)
    assert row[anchor == 0].tolist() == [0, 1]


def test_low_bounds():
    high = np.array([0, 1, 4, 99, 100, 101, 2**62])
    assert low_bounds(high, 80).tolist() == [-(-80 * int(h) // 100) for h in high]


def test_blocks_are_small():
    assert hard_negatives._BLOCK_ROWS * hard_negatives._BLOCK_ANCHORS * 8 <= 2**21
