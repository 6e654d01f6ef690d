import hashlib
import math
import random
import re
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from reelmart.llm import mixing as m


def brute_targets(sizes, share=(3, 2), cap=2, weights=m.WEIGHTS):
    """Reshare the excess until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget = Fraction(sum(sizes.values()) * share[0], share[1])
    target = {s: Fraction(0) for s in names}
    open_ = set(names)
    while open_ and budget:
        whole = sum(weight[s] for s in open_)
        over = [s for s in open_ if budget * weight[s] / whole >= cap * sizes[s]]
        if not over:
            return target | {s: budget * weight[s] / whole for s in open_}
        for s in over:
            target[s] = Fraction(cap * sizes[s])
            budget -= target[s]
            open_.remove(s)
    return target


def brute(rows):
    sizes = defaultdict(int)
    docs = []
    for i, source, text in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        sizes[source] += n
        docs.append((i, source, n, hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()))
    target = brute_targets(sizes)
    at, out = defaultdict(int), []
    for i, s, n, h in sorted(docs, key=lambda d: (d[3], d[2])):
        quota = math.floor(target[s])
        taken = sum(max(0, min(n, quota - at[s] - k * sizes[s])) for k in range(2))
        out.append((str(i), str(s), n, sizes[s], taken))
        at[s] += n
    return sorted(out), target


def run(df):
    return m.mix(df).collect()


def random_rows(n, seed):
    rnd = random.Random(seed)
    names = ["src0"] * 6 + ["b", "é", "A", "z", None, "src10", "src2"]
    return [(i, rnd.choice(names), "w " * rnd.choice([0, 1, 3, 50, 400])) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    rows = random_rows(400, seed)
    got = run(spark.createDataFrame(rows, "doc_id long, source string, text string"))
    want, target = brute(rows)
    assert sorted((str(r.id), str(r.source), r["size"], r.source_size, r.taken) for r in got) == want
    for r in got:
        assert abs(r.target - float(target[r.source])) < 1e-6 * max(1.0, r.target)
        assert r.taken <= 2 * r["size"] and r.taken == sum(p.words for p in r.passes)
    per = defaultdict(int)
    for r in got:
        per[r.source] += r.taken
    assert all(per[s] == math.floor(t) for s, t in target.items())


def test_positions(spark):
    """Sorted by position; each source's use follows its schedule."""
    rows = [(i, s, "w " * 10) for i, s in enumerate(["a", "b", "c"] * 400)]
    got = run(spark.createDataFrame(rows, "doc_id long, source string, text string"))
    first = [r.position for r in got if r.position is not None]
    assert first == sorted(first) and 0 <= first[0] and first[-1] < 1
    assert all(r.position is None for r in got[len(first):])
    half = defaultdict(int)
    whole = defaultdict(int)
    for r in got:
        for p in r.passes:
            half[r.source] += p.words * (p.position < 0.5)
            whole[r.source] += p.words
    part = {s: half[s] / whole[s] for s in whole}
    assert abs(part["a"] - 0.5) < 0.02  # steady
    assert abs(part["b"] - 0.375) < 0.02  # rising: (0.5 + 1) / 4
    assert abs(part["c"] - 0.625) < 0.02  # falling


@pytest.mark.parametrize("schedule", [(1, 1), (0, 2), (2, 0), (1, 0, 3), (0.5, 2, 2, 0.1)])
def test_time_inverts_the_demand(spark, schedule):
    n = 2000
    rows = [(i / n,) for i in range(n + 1)]
    got = [r.t for r in spark.createDataFrame(rows, "u double").select(
        m.demand_time(F.col("u"), schedule).alias("t")).collect()]
    k = len(schedule) - 1

    def demand(t):
        total = sum((a + b) / 2 for a, b in zip(schedule, schedule[1:]))
        done = 0.0
        for i, (a, b) in enumerate(zip(schedule, schedule[1:])):
            x = min(max(t * k - i, 0.0), 1.0)
            done += a * x + (b - a) * x * x / 2
        return done / total
    assert all(abs(demand(t) - u) < 1e-9 for (u,), t in zip(rows, got)) and got == sorted(got)


def test_bad_options(spark):
    for bad in ((1,), (-1, 2), (0, 0)):
        with pytest.raises(ValueError):
            m.demand_time(F.lit(0.5), bad)


def test_edge_rows(edge_docs, edge_rows, no_docs):
    rows = [(r[0], r[3], r[1]) for r in edge_rows]
    want, _ = brute(rows)
    assert sorted((str(r.id), str(r.source), r["size"], r.source_size, r.taken) for r in run(edge_docs)) == want
    assert m.mix(no_docs).count() == 0 and m.mixed_documents(no_docs).count() == 0


def test_only_empty_documents(spark):
    got = run(spark.createDataFrame([(1, "a", ""), (2, "b", None)], "doc_id long, source string, text string"))
    assert [(r.taken, r.target) for r in got] == [(0, 0.0)] * 2


def test_mixed_documents(spark, edge_docs):
    rows = random_rows(300, 9)
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    plan = {r.id: [p.position for p in r.passes if p.words * 2 >= r["size"]] for r in run(df)}
    got = m.mixed_documents(df)
    assert got.columns == df.columns
    ids = [r.doc_id for r in got.collect()]
    assert sorted(ids) == sorted(i for i, ps in plan.items() for _ in ps)
    assert ids == [i for _, i in sorted((p, i) for i, ps in plan.items() for p in ps)]
    assert m.mixed_documents(edge_docs).columns == edge_docs.columns


def test_reruns_agree(spark):
    df = spark.createDataFrame(random_rows(200, 4), "doc_id long, source string, text string")
    assert sorted(map(str, run(df))) == sorted(map(str, run(df.repartition(7))))
