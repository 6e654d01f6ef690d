import json
import random

import pytest
from pyspark.sql import functions as F

from reelmart.llm import tool_calls as t

CALLS = "conv_id long, turn long, call_id string, name string, arguments string, after string"
RESULTS = "conv_id long, turn long, call_id string, content string"
SCHEMAS = "name string, param string, type string, required boolean"
TOOLS = [("f", "q", "string", True), ("f", "n", "integer", False), ("f", "x", "number", False),
         ("f", "l", "array", False), ("f", "o", "object", False), ("f", "b", "boolean", False),
         ("f", "z", "null", None), ("g", None, None, None)]


def link(spark, calls, results=()):
    return t.link(spark.createDataFrame(list(calls), CALLS), spark.createDataFrame(list(results), RESULTS),
                  spark.createDataFrame(TOOLS, SCHEMAS)).collect()


def one(spark, arguments, name="f"):
    return link(spark, [(1, 0, "a", name, arguments, None)])[0]


@pytest.mark.parametrize("arguments,problems", [
    ('{"q": "x"}', ""), ('{"q": "x", "n": 3, "x": 1, "l": [], "o": {}, "b": true, "z": null}', ""),
    ('{"q": 1}', "type:q"), ("{}", "missing:q"), ('{"n": 1.5}', "missing:q,type:n"), ('{"q": "x", "x": 1.5}', ""),
    ('{"q": "x", "é": 1, "a": 2}', "unknown:a,unknown:é"), ("[1]", "not an object"), ("{", "not an object"),
    (None, "not an object"), ('{"q": "x", "q": "y"}', "not an object"), ('{"q": null}', "type:q")])
def test_validation(spark, arguments, problems):
    assert one(spark, arguments).problems == problems


def test_tools_without_parameters_and_unknown(spark):
    assert one(spark, "{}", "g").problems == "" and one(spark, '{"a": 1}', "g").problems == "unknown:a"
    assert one(spark, "{}", "h").problems == "tool" and one(spark, "{}", None).problems == "tool"


def test_canonical_json(spark):
    r = link(spark, [(1, 0, "a", "f", ' {"q" : "é\\n\\"", "o": {"b": 1.50, "a": [2.0, {"d": 1, "c": 2}]}} ', None)],
             [(1, 1, "a", "ok")])[0]
    assert r.message == ('{"arguments":{"o":{"a":[2,{"c":2,"d":1}],"b":1.5},"q":"é\\n\\""},"call_id":"a","conv_id":1,'
                         '"name":"f","result":"ok","turn":0}')
    again = link(spark, [(1, 0, "a", "f", json.dumps(json.loads(r.message)["arguments"], indent=1), None)], [(1, 1, "a", "ok")])
    assert again[0].message == r.message
    assert json.loads(one(spark, "{oops").message)["raw_arguments"] == "{oops"


def test_topological_order(spark):
    """Predecessors come first even where their turns come later."""
    calls = [(1, 5, "a", "f", "{}", "b"), (1, 9, "b", "f", "{}", "c"), (1, 2, "c", "f", "{}", None),
             (1, 5, "d", "f", "{}", "a"), (1, 1, "e", "f", "{}", "d"), (1, 3, "f", "f", "{}", "nowhere"),
             (2, 1, "a", "f", "{}", "b"), (2, 2, "b", "f", "{}", "a"), (2, 3, "x", "f", "{}", "a"),
             (2, 4, "self", "f", "{}", "self"), (None, 1, "a", "f", "{}", "b"), (None, 2, "b", "f", "{}", None)]
    calls += [(3, 1000 - i, f"k{i}", "f", "{}", f"k{i - 1}" if i else None) for i in range(150)]
    rows = link(spark, calls)
    place = {(r.conv_id, r.call_id): (r.sort_turn, r.depth, r.turn, r.call_id) for r in rows}
    status = {(r.conv_id, r.call_id): r.status for r in rows}
    for conv, _, call, _, _, after in calls:
        if (conv, after) in place and status[conv, call] != "cyclic":
            assert place[conv, after] < place[conv, call]
    assert {k for k, s in status.items() if s == "cyclic"} == {(2, "a"), (2, "b"), (2, "x"), (2, "self")}
    assert place[3, "k149"][1] == 149


def brute_places(calls):
    """(latest turn, longest path) by recursion; None on or after a cycle."""
    node = {c: (turn, [p for p in after or [] if p is not None]) for _, turn, c, _, _, after in calls}
    node = {c: (turn, [p for p in after if p in node]) for c, (turn, after) in node.items()}
    memo = {}

    def place(c, path=()):
        if c in path:
            return None
        if c not in memo:
            got = [place(p, (*path, c)) for p in node[c][1]]
            if None in got:
                return None
            memo[c] = (max([node[c][0], *[g[0] for g in got]]), max([0, *[g[1] + 1 for g in got]]))
        return memo[c]
    return {c: place(c) for c in node}


def random_graph(seed, size, back):
    rnd = random.Random(seed)
    out = []
    for i in range(size):
        after = [f"k{rnd.randrange(max(0, i - 9), i)}" for _ in range(rnd.choice([0, 1, 1, 1, 2, 5]))] if i else None
        if rnd.random() < back:
            after = [*(after or []), f"k{rnd.randrange(size)}"]
        out.append((1, rnd.randrange(50), f"k{i}", "f", "{}", after and [*after, None, "nowhere", after[0]]))
    return out


@pytest.mark.parametrize("calls", [
    random_graph(1, 60, 0), random_graph(2, 60, 0.04), random_graph(3, 12, 0.5),
    # layers of calls that all wait for both of the layer before, after a cycle that runs on beside them
    [(1, 99 - i, f"{x}{i}", "f", "{}", [f"a{i - 1}", f"b{i - 1}"]) for i in range(6) for x in "ab"]
    + [(1, 1, "x", "f", "{}", ["y"]), (1, 2, "y", "f", "{}", ["x"]), (1, 3, "z", "f", "{}", ["x", "a5"])],
    # one call that waits for all others, and one that all others wait for
    [(1, 5, "first", "f", "{}", [])] + [(1, i % 7, f"m{i}", "f", "{}", ["first"]) for i in range(300)]
    + [(1, 0, "last", "f", "{}", [f"m{i}" for i in range(300)])]])
def test_several_predecessors(spark, calls):
    rows = t.link(spark.createDataFrame(calls, CALLS.replace("after string", "after array<string>")),
                  spark.createDataFrame([], RESULTS), spark.createDataFrame(TOOLS, SCHEMAS)).collect()
    got = {r.call_id: None if r.status == "cyclic" else (r.sort_turn, r.depth) for r in rows}
    assert len(rows) == len(calls) and got == brute_places(calls)
    place = {r.call_id: (r.sort_turn, r.depth) for r in rows}
    for _, _, c, _, _, after in calls:
        assert got[c] is None or all(place[p] < place[c] for p in after or [] if p in place)


def test_long_texts_and_clashing_columns(spark):
    """Extra columns are ignored whatever their names; long texts stay whole."""
    long = "wörd " * 200_000
    calls = spark.createDataFrame([(1, 1, "a", "f", json.dumps({"q": long}), None)], CALLS)
    results = spark.createDataFrame([(1, 2, "a", long)], RESULTS)
    extra = {c: F.lit(1) for c in ["n", "top", "hops", "next", "on", "same", "c", "o", "g", "status", "tool", "params",
                                   "args", "sort_turn", "depth", "cyclic", "message", "problems", "owner"]}
    r = t.link(calls.withColumns(extra), results.withColumns(extra),
               spark.createDataFrame(TOOLS, SCHEMAS).withColumns(extra)).collect()
    assert len(r) == 1 and r[0].status == "linked" and r[0].problems == ""
    got = json.loads(r[0].message)
    assert got["result"] == long and got["arguments"]["q"] == long


def test_statuses(spark):
    calls = [(1, 1, "a", "f", "{}", None), (1, 1, "a", "f", "{}", None), (1, 2, "a", "g", "{}", None),
             (1, 3, None, "f", "{}", None), (1, 4, "p", "f", "{}", None), (None, None, "n", None, None, None)]
    results = [(1, 7, "a", "late"), (1, 3, "a", "early"), (1, 3, "zz", "lost"), (1, 3, None, None),
               (2, 3, "a", "other talk"), (None, None, "n", None)]
    rows = sorted(((str(r.conv_id), str(r.call_id), r.status, r.n_results) for r in link(spark, calls, results)))
    assert rows == [("1", "None", "no id", 0), ("1", "None", "orphan", 1), ("1", "a", "duplicate", 0),
                    ("1", "a", "duplicate", 0), ("1", "a", "linked", 2), ("1", "p", "pending", 0),
                    ("1", "zz", "orphan", 1), ("2", "a", "orphan", 1), ("None", "n", "linked", 1)]
    first = next(r for r in link(spark, calls, results) if r.status == "linked" and r.call_id == "a")
    assert json.loads(first.message)["result"] == "early" and first.turn == 1


def test_extract(spark):
    rows = [(1, 0, json.dumps({"tool_calls": [{"id": "a", "name": "f", "arguments": {"q": "x"}, "after": None},
                                              {"id": "b", "name": "g", "arguments": "{}", "after": "a"},
                                              {"id": "c", "name": "g", "after": ["a", "b"]}]})),
            (1, 1, json.dumps({"tool_call_id": "a", "content": "ok"})), (1, 2, "hello"), (1, 3, None), (2, 0, "{broken")]
    calls, results = t.extract(spark.createDataFrame(rows, "conv_id long, turn long, text string"))
    got = {(r.call_id, r.name, r.arguments, tuple(r.after)) for r in calls.collect()}
    assert got == {("a", "f", '{"q":"x"}', (None,)), ("b", "g", "{}", ("a",)), ("c", "g", None, ("a", "b"))}
    assert [(r.turn, r.call_id, r.content) for r in results.collect()] == [(1, "a", "ok")]


def test_empty_tables(spark):
    assert link(spark, []) == []
    assert len(link(spark, [], [(1, 1, "a", "x")])) == 1


def test_hot_conversation_and_hot_identifier(spark):
    calls = [(7, i, f"c{i}", "f", '{"q":"x"}', f"c{i - 1}") for i in range(3000)] + [(8, 1, "same", "f", "{}", None)] * 2000
    rows = link(spark, calls, [(8, 2, "same", "r")] * 1000)
    assert len(rows) == 5000
    assert sum(r.status == "duplicate" for r in rows) == 1999
    assert next(r.n_results for r in rows if r.status == "linked") == 1000
