import random

from reelmart.llm._common import Shared
from reelmart.llm.components import components


def brute(links):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for u, v in links:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_random_graphs_paths_and_hubs(spark):
    rnd = random.Random(5)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)]
    links += [(1000 + i, 1001 + i) for i in range(130)]  # a path
    links += [(5000, 5000 + i) for i in range(1, 400)] + [(5000, 5001)] * 3  # a hub, repeated links
    got = components(spark.createDataFrame(links, "u long, v long"), Shared(spark, "test")).collect()
    want = {k: v for k, v in brute([x for x in links if x[0] != x[1]]).items()}
    assert {r.node: r.component for r in got} == want and len(got) == len(want)


def test_null_loop_and_empty(spark):
    df = spark.createDataFrame([(1, 1), (None, 2), (3, None)], "u long, v long")
    assert components(df, Shared(spark, "test")).count() == 0
    assert components(df.limit(0), Shared(spark, "test")).count() == 0
