import math
import random

import numpy as np
import pytest

from reelmart.llm import embedding_neardup as e

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.95):
    ok = []
    for i, v, *_ in rows:
        v = None if v is None or any(x is None for x in v) else np.array(v, np.float32).astype(float)
        ok.append(v if v is not None and len(v) and np.isfinite(v).all() and (v != 0).any() else None)
    n, links, root = len(rows), [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(n):
        for j in range(i):
            a, b = ok[i], ok[j]
            if a is not None and b is not None and len(a) == len(b):
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / math.sqrt(a @ a) / math.sqrt(b @ b) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    low = {}
    for i in range(n):
        r = find(i)
        if rows[i][0] is not None:
            low[r] = min(low.get(r, rows[i][0]), rows[i][0])
    out = []
    for i in range(n):
        c = low.get(find(i)) if ok[i] is not None else rows[i][0]
        out.append((str(rows[i][0]), links[i], str(c), rows[i][0] is not None and rows[i][0] == c))
    return sorted(out)


def run(spark, rows, schema=SCHEMA):
    out = e.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    return sorted((str(r.id), r.n_links, str(r.component), r.kept) for r in out)


def clustered(seed, dim, clusters, size, spread):
    rnd = np.random.default_rng(seed)
    rows = []
    for _ in range(clusters):
        center = rnd.standard_normal(dim)
        center /= np.linalg.norm(center)
        for _ in range(int(rnd.integers(1, size))):
            rows.append((center + rnd.standard_normal(dim) * spread / math.sqrt(dim)) * rnd.uniform(0.1, 9))
    return [(i, [float(np.float32(x)) for x in v], i % 3) for i, v in enumerate(rows)]


@pytest.mark.parametrize("dim,spread", [(16, 0.2), (64, 0.22), (96, 0.25), (3, 0.1)])
def test_all_pairs_near_the_threshold(spark, dim, spread):
    rows = clustered(dim, dim, 40, 12, spread)
    assert run(spark, rows) == brute(rows)


def test_large_bucket_is_split_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(e, "BLOCK", 16)
    rows = clustered(3, 32, 3, 200, 0.15)
    assert run(spark, rows) == brute(rows)


def test_edge_rows(spark):
    a, b = [1.0, 0.0, 0.0, 0.0], [0.99, 0.05, 0.0, 0.0]
    rows = [(1, a, 0), (2, a, 1), (2, a, 1), (3, b, 0), (4, None, 0), (5, [], 0), (6, [0.0] * 4, 0), (None, a, 0),
            (7, [1.0, None, 0.0, 0.0], 0), (8, [float("nan"), 1.0, 0.0, 0.0], 0), (9, [float("inf"), 0.0, 0.0, 0.0], 0),
            (10, [1e38, 0.0, 0.0, 0.0], 0), (11, [1e-38, 0.0, 0.0, 0.0], None), (12, [-1.0, 0.0, 0.0, 0.0], 0),
            (13, [1.0, 0.0], 0), (14, [2.0, 0.0], 0), (15, [-0.0, 1.0, 0.0, 0.0], 0), (16, [0.0, 1.0, 0.0, 0.0], 0),
            (None, None, None), (0, b, 0)]
    assert run(spark, rows) == brute(rows)


def test_exact_threshold_links(spark):
    """Just at and just below the threshold in double precision."""
    t = 0.95
    rows = [(1, [1.0, 0.0]), (2, [t, math.sqrt(1 - t * t)]), (3, [t - 1e-9, math.sqrt(1 - (t - 1e-9) ** 2)])]
    schema = "vec_id long, embedding array<double>"
    out = {r.id: r.n_links for r in e.near_duplicates(spark.createDataFrame(rows, schema)).collect()}
    a = np.array(rows[1][1])
    assert out[1] == int(a[0] / np.linalg.norm(a) >= t)


def test_extra_columns_and_empty_table(spark):
    df = spark.createDataFrame(clustered(1, 8, 3, 4, 0.1), SCHEMA).selectExpr(
        "*", "1 AS node", "2 AS id", "3 AS h1", "4 AS component", "5 AS band", "6 AS vec")
    assert e.near_duplicates(df).count() == df.count()
    assert e.near_duplicates(df.limit(0)).count() == 0


def test_estimates_are_unbiased_and_bounded():
    rnd = np.random.default_rng(6)
    u = e.unit(rnd.standard_normal((400, 64)))
    v = e.unit(u + rnd.standard_normal((400, 64)) * 0.05)
    code, factor = e.encode(u)
    signs = (np.unpackbits(code, axis=1, count=64) * 2.0 - 1) / 8
    est = (signs * (v @ e.rotation(64))).sum(axis=1) / factor
    exact = (u * v).sum(axis=1)
    slack = np.sqrt(1 - factor ** 2) / factor * e.EPSILON / math.sqrt(63)
    assert abs((est - exact).mean()) < 0.01 and (np.abs(est - exact) <= slack).all()


def test_band_shape():
    for n in (2, 500, 10 ** 5, 10 ** 9):
        bits, bands = e.band_shape(n, 0.95)
        same = (1 - math.acos(0.95) / math.pi) ** bits
        assert (1 - same) ** bands <= e.MISS and n / 2 ** bits <= 1
    random.seed(0)
