"""Hard negatives against brute force, over many cells, blocks and rounds."""

import math
from collections import Counter

import numpy as np
import pytest

from metaloom.llm.hard_negatives import MultiIndex, cell_order, hard_negatives, inner_products

SCHEMA = "vec_id long, label int, embedding array<float>, cell int"


def brute(rows, positives=5, negatives=3):
    kept = {(i, y, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, y, v, _ in rows
            if i is not None and y is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for anchor, label, a in kept:
        if anchor % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i, y) for i, y, b in kept if i != anchor and len(b) == len(a))
        for p, i, _ in [s for s in scored if s[2] == label][:positives]:
            near = [s for s in scored if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p][:negatives]
            out += [(anchor, i, rank, n, -p, -s) for rank, (s, n, _) in enumerate(near, 1)]
    return Counter(out)


def found(df):
    return Counter(tuple(r) for r in df.collect())


def clustered(n, dims, centres, spread, seed):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims))
    own = rng.integers(0, centres, n)
    vectors = (middle[own] + spread * rng.normal(size=(n, dims))).astype(np.float32)
    return [(i, int(own[i] % 4 if i % 3 else i % 5), [float(x) for x in v], 1) for i, v in enumerate(vectors)]


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_against_brute_force(spark, spread):
    rows = clustered(900, 9, 12, spread, 4)
    got = hard_negatives(spark.createDataFrame(rows, SCHEMA), cell_rows=20, block_rows=16, anchor_rows=4)
    want = brute(rows)
    assert found(got) == want and sum(want.values()) > 20


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(160, 6, 3, 0.3, 9)
    rows += [(200 + i, 1, rows[3][2], 1) for i in range(60)]  # a crowd of equal vectors, and so of ties
    rows += rows[:7] + [(50, 2, rows[9][2], 1)]  # copies, and an id with two vectors
    rows += [(None, 1, [1.0] * 6, 1), (300, None, [1.0] * 6, 1), (350, 1, None, 1), (400, 1, [], 1), (450, 1, [1.0, None] * 3, 1)]
    rows += [(500, 1, [nan] * 6, 1), (550, 1, [inf] + [1.0] * 5, 1), (600, 1, [0.0] * 6, None)]
    rows += [(650, 1, [1.0, 2.0], 1), (651, 1, [1.0, 1.0], 1), (652, 2, [0.8, 0.8], 1), (700, 3, [1.0] * 7, 1)]
    got = hard_negatives(spark.createDataFrame(rows, SCHEMA), cell_rows=10, block_rows=8, anchor_rows=3)
    assert found(got) == brute(rows)


def test_no_rows(spark):
    assert hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
    assert hard_negatives(spark.createDataFrame([(1, 1, [1.0], 1), (3, 1, [1.0], 1)], SCHEMA)).count() == 0
    assert hard_negatives(spark.createDataFrame([(50, 1, [1.0], 1)], SCHEMA)).count() == 0


def test_cells_come_by_falling_bounds():
    rng = np.random.default_rng(2)
    for _ in range(20):
        one, two = np.round(rng.normal(size=7), 1), np.round(rng.normal(size=5), 1)
        rows = rng.integers(0, 2, 35)
        order = list(cell_order(one, two, rows))
        assert sorted(c for _, c in order) == list(np.flatnonzero(rows))
        assert all(b == one[c // 5] + two[c % 5] for b, c in order)
        assert [b for b, _ in order] == sorted((b for b, _ in order), reverse=True)


def test_bounds_hold():
    rng = np.random.default_rng(3)
    rows, asked = np.floor(rng.normal(0, 200, (300, 8))), np.floor(rng.normal(0, 200, (20, 8)))
    centres = (rng.normal(0, 200, (4, 4)), rng.normal(0, 200, (3, 4)))
    own, far = MultiIndex(centres, (np.zeros(0), np.zeros(0)), np.zeros(0)).place(rows)
    radii = tuple(np.array([f[o == i].max(initial=0) for i in range(len(c))]) for o, f, c in zip(own, far, centres))
    one, two = MultiIndex(centres, radii, np.zeros(0)).reaches(asked)
    scores = asked @ rows.T
    upper = (one[0] + one[1])[:, own[0]] + (two[0] + two[1])[:, own[1]]
    lower = (one[0] - one[1])[:, own[0]] + (two[0] - two[1])[:, own[1]]
    assert (scores <= upper).all() and (scores >= lower).all()


def test_large_numbers_are_exact():
    big = np.array([[2.0**30, 1.0, 3.0]])
    assert inner_products(big, big).tolist() == [[2**60 + 10]]
    with pytest.raises(OverflowError):
        inner_products(big * 2.0**20, big * 2.0**20)
