import random

import numpy as np
import pytest
from conftest import CLASHES
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelmart.llm import hard_negatives as h

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100, k=5, low=80, high=100):
    """Result rows for (id, label, q) whose id is divisible by ``every``."""
    out = []
    key = lambda x: (-x[0], x[1] is None, x[1] or 0)
    for a, (i, label, q) in enumerate(rows):
        if i is None or i % every:
            continue
        score = [(sum(x * y for x, y in zip(q, r[2])), r[0], r[1], j) for j, r in enumerate(rows) if len(r[2]) == len(q)]
        positives = sorted((x for x in score if x[2] == label and x[3] != a), key=key)[:k]
        negatives = sorted((x for x in score if x[2] != label), key=key)
        for p in positives:
            own = [x for x in negatives if low * p[0] <= 100 * x[0] <= high * p[0]][:k]
            out += [(i, p[1], rank + 1, n[1], p[0], n[0]) for rank, n in enumerate(own)]
    return sorted(out, key=repr)


def read(rows):
    """What the contract reads from (vec_id, embedding, label)."""
    ok = [r for r in rows if r[1] is not None and r[2] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    return [(i, l, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, l in ok]


def mined(df, every=100, **options):
    out = h.mine(h.scaled(df), F.col("id") % every == 0, **options)
    return sorted((tuple(r) for r in out.collect()), key=repr)


def vectors(seed, n, dims=12, labels=4):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(dims)] for _ in range(labels)]
    return [(i, [0.7 * c + 0.6 * rnd.gauss(0, 1) for c in centres[i % labels]], rnd.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("cells", [{}, {"rows_a_block": 37, "anchors_a_chunk": 3}])
def test_against_brute_force(spark, cells):
    rows = vectors(1, 600)
    got = mined(spark.createDataFrame(rows, SCHEMA), 20, **cells)
    assert got == brute(read(rows), 20) and len(got) > 200


def test_windows_and_counts_are_parameters(spark):
    rows = vectors(2, 300)
    got = mined(spark.createDataFrame(rows, SCHEMA), 30, positives=3, negatives=7, low=50, high=90, rows_a_block=50)
    out = []
    for r in brute(read(rows), 30, 10 ** 6, 50, 90):
        out.append(r)
    want, best = [], {}
    for a, p, rank, n, ps, ns in out:
        best.setdefault(a, {})[(-ps, p)] = None
    first = {a: sorted(x)[:3] for a, x in best.items()}
    for r in out:
        if (-r[4], r[1]) in first[r[0]] and r[2] <= 7:
            want.append(r)
    # positives without a negative in their window do not show in either
    assert [r for r in got if (-r[4], r[1]) in first[r[0]]] == sorted(want, key=repr)


def test_edge_rows(spark):
    v = [1.0, -0.5, 0.25]
    rows = [(0, v, 1), (0, v, 1), (1, v, 1), (2, v, 2), (3, [0.9, -0.5, 0.2], 2), (None, v, 1), (None, [0.95, -0.5, 0.25], 3),
            (4, None, 1), (5, v, None), (6, [1.0, None, 0.0], 1), (8, [float("nan"), 0.0, 0.0], 1), (9, [float("inf"), 0.0, 0.0], 2),
            (100, [], 1), (101, [], 1), (102, [], 2), (200, [0.0, 0.0, 0.0], 1), (300, [-1.0, 0.5, -0.25], 2),
            (400, [0.001, 0.0], 3), (401, [0.002, 0.0], 3), (402, [0.0019, 0.0], 1), (500, [3.0e38, 0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in [*CLASHES, "q", "scores", "block", "rank"]})
    assert h.scaled(df).columns == ["id", "label", "q"]
    want = brute([r for r in read(rows) if r[0] != 500])
    assert mined(df, rows_a_block=4, anchors_a_chunk=2) == want and mined(df) == want
    assert {r[0] for r in want} >= {0, 100}


def test_many_copies_of_one_vector(spark):
    rows = [(i, [0.5, 0.5, -0.25, 1.0], i % 2) for i in range(700)] + [(1000 + i, v, l) for i, v, l in vectors(5, 200, 4, 2)]
    got = mined(spark.createDataFrame(rows, SCHEMA), 100, rows_a_block=64)
    assert got == brute(read(rows), 100)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    out = h.mine(h.scaled(empty), F.col("id") % 100 == 0)
    assert out.count() == 0 and out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert mined(spark.createDataFrame(vectors(6, 50), SCHEMA).filter("vec_id % 100 <> 0")) == []


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(1, 40), st.integers(1, 20), st.integers(1, 4))
def test_scan_drops_nothing_that_counts(seed, n, dims, k):
    rnd = np.random.default_rng(seed)
    x = rnd.integers(-20, 20, (dims, n))
    a = rnd.integers(-20, 20, dims)
    alive = rnd.random(n) < 0.7
    full = a @ x
    rows, scores = h.scan(a, x, x.min(axis=1), x.max(axis=1), alive, h.nearest(k))
    assert (scores == full[rows]).all()
    assert sorted(-full[alive])[:k] == sorted(-scores)[:k]
    windows = [(int(w), int(w) + 60) for w in rnd.integers(-200, 200, 2)]
    rows, scores = h.scan(a, x, x.min(axis=1), x.max(axis=1), alive, h.in_windows(windows, k))
    for lo, hi in windows:
        inside = lambda s: sorted(-s[(s >= lo) & (s <= hi)])[:k]
        assert inside(full[alive]) == inside(scores)


def test_scan_reads_few_dimensions_of_far_rows():
    """Rows that point away from the anchor leave the bitmap after the first dimensions."""
    a = np.array([1000, *[1] * 31])
    x = np.ones((32, 100), np.int64)
    x[0, 10:] = -1000
    seen = []
    def keep(lower, upper):
        seen.append(len(lower))
        return h.nearest(5)(lower, upper)
    h.scan(a, x, x.min(axis=1), x.max(axis=1), np.ones(100, bool), keep)
    assert seen == [100, 10, 10, 10]
