import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from conftest import CLASHES
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelmart.llm import conversation_repair as c

SCHEMA = "conv_id long, turn long, role string, text string"
GOOD = re.compile(r"(s?(ua)+)?\Z")
SOLID = re.compile(r"[^\x20\x09-\x0D]")


def fault_of(role, text, seen):
    if not SOLID.search(text):
        return "blank"
    if (role, text) in seen:
        return "duplicate"
    return "" if SOLID.findall(text)[-1] in ".!?" else "truncated"


def every_edit(rows, faults):
    """Cheapest (cost, letters, messages) by trying all edits; at most two messages inserted at a place."""
    best = None
    options = []
    for (role, text), fault in zip(rows, faults):
        own = [("D", 2, None)]
        if fault not in ("blank", "duplicate"):
            more = 5 * (fault == "truncated")
            own += [("K", more, (role, text)), ("R", 1 + more, ("user", text)), ("R", 1 + more, ("assistant", text))]
        options.append(own)
    gaps = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    for picks in product(*options):
        for fill in product(gaps, repeat=len(rows) + 1):
            letters, cost, out = "", 0, []
            for i, gap in enumerate(fill):
                letters += "I" * len(gap)
                cost += 5 * len(gap)
                out += [(g, "") for g in gap]
                if i < len(picks):
                    letters += picks[i][0]
                    cost += picks[i][1]
                    out += [picks[i][2]] if picks[i][2] else []
            if GOOD.match("".join(r[:1] or "?" for r, _ in out)) and (best is None or (cost, letters) < best[:2]):
                best = (cost, letters, out)
    return best


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", ""]),
                          st.sampled_from(["", "a.", "b!", "open"])), max_size=3))
def test_solver_against_all_edits(rows):
    seen, faults = set(), []
    for r in rows:
        faults.append(fault_of(*r, seen))
        seen.add(r)
    solver = [c.Row(r[:1], f in ("blank", "duplicate"), f == "truncated") for (r, _), f in zip(rows, faults)]
    letters, state = c.hirschberg(solver, 0, list(c.END))
    want = every_edit(rows, faults)
    assert "".join(letters) + "I" * (c.END[state] // c.INSERT) == want[1]


def slow(rows):
    """Least letters by a table of (cost, letters, messages) per state, row by row."""
    seen, faults = set(), []
    for r in rows:
        faults.append(fault_of(*r, seen))
        seen.add(r)
    now = {0: (0, "", ())}
    add = lambda x, cost, letter, out=(): (x[0] + cost, x[1] + letter, x[2] + out)
    for (role, text), fault in zip(rows, faults):
        new = {}
        for s, x in now.items():
            for k in range(3):
                options = [(s, add(x, 2, "D"))]
                if fault not in ("blank", "duplicate"):
                    more = 5 * (fault == "truncated")
                    if role[:1] in c.NEXT[s]:
                        options.append((c.NEXT[s][role[:1]], add(x, more, "K", ((role, text),))))
                    options.append((c.AFTER[s], add(x, 1 + more, "R", ((c.EXPECTED[s], text),))))
                for t, y in options:
                    if t not in new or y < new[t]:
                        new[t] = y
                s, x = c.AFTER[s], add(x, 5, "I", ((c.EXPECTED[s], ""),))
        now = new
    done = []
    for s, x in now.items():
        while s in (1, 2):
            s, x = c.AFTER[s], add(x, 5, "I", ((c.EXPECTED[s], ""),))
        done.append(x)
    cost, letters, out = min(done)
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(rows, rows[1:])]
    return (faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, letters,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def in_order(rows):
    """Conversation -> its rows (turn, role, text) in order."""
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn, role or "", text or ""))
    for r in out.values():
        r.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.md5(x[2].encode()).hexdigest()))
    return out


def want_of(rows):
    out = {}
    for conv, own in in_order(rows).items():
        turns = [t for t, *_ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *slow([r[1:] for r in own]))
    return out


def got_of(steps):
    return {r.conv: tuple(r)[1:] for r in c.digests(steps).collect()}


def conversations(seed, n, longest=9):
    rnd = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rnd.randint(1, longest)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rnd.choice(["Yes.", "No!", "cut", "", " \t", "Why?  ", "fine.\n", None, "é😀", f"own {turn}."])
            rows.append((conv, rnd.choice([turn, turn, None, turn + 3]), role, text))
    return rows


@pytest.mark.parametrize("ranges", [None, 1, 40])
def test_random_conversations(spark, ranges):
    rows = conversations(ranges or 0, 150)
    assert got_of(c.repair(spark.createDataFrame(rows, SCHEMA), ranges=ranges)) == want_of(rows)


@pytest.mark.parametrize("ranges", [2, 9])
def test_one_conversation_over_many_parts(spark, ranges):
    rnd = random.Random(8)
    rows = [(7, t, rnd.choice(["user", "assistant", "system", "x"]), rnd.choice(["a.", "b", "", f"t {t}.", f"t {t}"]))
            for t in range(1500)] + [(8, 1, "user", "hi.")]
    steps = c.repair(spark.createDataFrame(rows, SCHEMA), ranges=ranges)
    assert got_of(steps) == want_of(rows)


def test_steps_are_the_repaired_conversation(spark):
    rows = [(1, 0, "user", "a?"), (1, 1, "user", "a?"), (1, 1, "user", "a?"), (1, 2, "assistant", "b"), (1, 5, "user", "c.")]
    steps = c.repair(spark.createDataFrame(rows, SCHEMA)).orderBy("at", "k").collect()
    assert [(s.turn, s.action, s.role, s.text, s.times, s.cost, s.fault) for s in steps] == [
        (0, "K", "user", "a?", 1, 0, None), (1, "D", None, None, 1, 2, "duplicate"), (1, "D", None, None, 1, 2, "duplicate"),
        (2, "D", None, None, 1, 2, "truncated"), (5, "R", "assistant", "c.", 1, 1, None)]


def test_edge_rows(spark):
    long = "long text " * 50_000 + "."
    rows = [(None, None, None, None), (None, 1, "user", "hi."), (None, 1, "user", "hi."), (2, None, "user", "x."),
            (2, None, "assistant", "y."), (3, 0, "user", long), (3, 1, "assistant", long[:-1]), (4, 1, "", ""),
            (5, 3, "supervisor", "go."), (5, 4, "User", "go."), (6, -2, "user", "😀?"), (6, 2 ** 40, "assistant", "ü.")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns(
        {x: F.lit("x") for x in [*CLASHES, "conv", "part", "copies", "entry", "exit", "seen", "action", "blank"]})
    for ranges in (1, 30):
        assert got_of(c.repair(df, ranges=ranges)) == want_of(rows)


def test_copies_by_count_equal_copies_by_row(spark):
    rows = [(1, 1, "user", "a."), (1, 2, "assistant", "b"), (1, 3, "user", "")]
    df = spark.createDataFrame([(*r, n) for r, n in zip(rows, (1, 40, 3))], SCHEMA + ", m int")
    spread = [r for r, n in zip(rows, (1, 40, 3)) for _ in range(n)]
    assert got_of(c.repair(df, F.col("m"))) == got_of(c.repair(spark.createDataFrame(spread, SCHEMA))) == want_of(spread)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert c.repair(empty).count() == 0 and c.digests(c.repair(empty)).count() == 0 and c.damage(empty).count() == 0


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        show = lambda x: " " if x is None else str(x)
        kind, role, text = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20, show(role), show(text)
        if kind:
            out += [(conv, turn, "user" if kind == 4 else role,
                     "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)] * (2 if kind == 3 else 1)
    return out


def test_query_on_edge_rows(spark, scratch):
    from reelmart.llm.queries import QUERIES
    rows = [r for r in conversations(4, 200) if r[1] is not None] + [(None, 3, "user", "a."), (None, None, None, None), (-5, None, "user", "b")]
    rows += [(k, 0, "user", "gone.") for k in range(1000, 1300) if zlib.crc32(f"{k}:0".encode()) % 20 == 0][:3]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{scratch}/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:] for r in QUERIES["op11_conversation_repair"](spark, scratch).collect()}
    want = want_of(damaged(rows))
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert got == {conv: want.get(conv, empty) for conv in {r[0] for r in rows}} and empty in got.values()
