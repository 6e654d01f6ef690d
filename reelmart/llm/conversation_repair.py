"""Conversation structure repair by Hirschberg's divide and conquer.

A repaired conversation is empty, or an optional system message followed by
pairs of user and assistant. Four states read that: nothing yet, after the
system message, after a user, after an assistant. Rows are kept, given another
role, deleted or preceded by inserted empty messages, each at a cost. The
cheapest edits are found in linear space: a vector of four costs runs forward
to the middle of a conversation and one runs backward to it; where they meet,
every state with the least sum is an optimal crossing. Both halves are solved
the same way. Of several optimal crossings the one whose letters (D, I, K, R)
read least is taken: the left half is solved towards all of them at once, with
the backward costs as its goal. Inserted messages belong to the half of the
row that they precede, so that no left half's letters are the beginning of
another's, and comparing halves is comparing wholes.

Rows are sorted into ranges of conversation and turn, so that a conversation
of any size is cut over as many tasks as it fills. A conversation within one
range is solved there. For one that is cut, each part gives the costs from
state to state and the order of the letters that reach them; those few numbers
per part decide the states at the cuts, and the parts are then solved
independently. Rows equal in conversation, turn, role and text travel as one
row with a count: all but the first are deleted as duplicates in any case.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart.llm._common import SPACE_CHARS, Shared, find_package

FAR = 1 << 50  # a cost that no path has
KEEP, REROLE, DELETE, INSERT, OPEN = 0, 1, 2, 5, 5
#: The state after a message of that initial, by state.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: The role that an inserted or re-roled message has, by state, and the state after it.
EXPECTED = ("user", "user", "assistant", "user")
AFTER = (2, 2, 3, 2)
#: What ending in a state costs: nothing when empty or complete, else the missing messages.
END = (0, 2 * INSERT, INSERT, 0)
LEGAL = {"su", "ua", "au"}


def damage(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies`` of rows damaged by their key's CRC-32.

    Nulls read as one space, in the key too. By the remainder modulo 20: 0 the
    row is dropped, 1 its text is emptied, 2 ``[.!?]`` go, 3 it occurs twice, 4
    its role is user.
    """
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), kind.alias("kind"))
    return rows.filter("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"), F.when(F.col("kind") == 3, 2).otherwise(1).alias("copies"))


# ---------------------------------------------------------------- one part

class Row:
    """A row as the solver sees it: its initial, whether it must go, its extra cost if kept."""

    __slots__ = ("forced", "extra", "options")

    def __init__(self, initial: str, forced: bool, is_open: bool):
        self.forced, self.extra = forced, OPEN if is_open else 0
        # (letter, cost, state after) by state
        self.options = []
        for state in range(4):
            own = [("D", DELETE, state)]
            if not forced:
                if initial in NEXT[state]:
                    own.append(("K", KEEP + self.extra, NEXT[state][initial]))
                own.append(("R", REROLE + self.extra, AFTER[state]))
            self.options.append(own)


def _forward(costs: list[int], row: Row) -> list[int]:
    costs = list(costs)
    for _ in range(2):  # two inserted messages reach every state
        for s, c in enumerate(list(costs)):
            costs[AFTER[s]] = min(costs[AFTER[s]], c + INSERT)
    out = [FAR] * 4
    for s, c in enumerate(costs):
        for _, cost, t in row.options[s]:
            out[t] = min(out[t], c + cost)
    return out


def _backward(goal: list[int], row: Row) -> list[int]:
    out = [min(cost + goal[t] for _, cost, t in row.options[s]) for s in range(4)]
    for _ in range(2):
        out = [min(out[s], INSERT + out[AFTER[s]]) for s in range(4)]
    return out


def _one(row: Row, state: int, goal: list[int]) -> tuple[str, int]:
    best = (FAR * 4, "", state)
    for k in range(3):
        for letter, cost, t in row.options[state]:
            best = min(best, (k * INSERT + cost + goal[t], "I" * k + letter, t))
        state = AFTER[state]
    return best[1], best[2]


def hirschberg(rows: list[Row], state: int, goal: list[int], lo: int = 0, hi: int | None = None) -> tuple[list[str], int]:
    """The least letters of the cheapest edits of ``rows[lo:hi]`` from ``state``,
    one string per row, and the state they end in; ``goal``: cost of each end."""
    hi = len(rows) if hi is None else hi
    if hi - lo == 0:
        return [], state
    if hi - lo == 1:
        letters, end = _one(rows[lo], state, goal)
        return [letters], end
    mid = (lo + hi) // 2
    there = [FAR] * 4
    there[state] = 0
    for row in rows[lo:mid]:
        there = _forward(there, row)
    back = goal
    for i in range(hi - 1, mid - 1, -1):
        back = _backward(back, rows[i])
    least = min(a + b for a, b in zip(there, back))
    crossing = [b if a + b == least else FAR for a, b in zip(there, back)]
    left, state = hirschberg(rows, state, crossing, lo, mid)
    right, state = hirschberg(rows, state, goal, mid, hi)
    return left + right, state


def summary(rows: list[Row]) -> tuple[list[int], list[int]]:
    """Costs from state to state (four by four), and for each state of entry the
    order in which the least letters to each end read."""
    costs, ranks = [], []
    for s in range(4):
        there = [FAR] * 4
        there[s] = 0
        for row in rows:
            there = _forward(there, row)
        costs += [min(c, FAR) for c in there]
        goal = lambda t: [0 if x == t else FAR for x in range(4)]
        letters = ["".join(hirschberg(rows, s, goal(t))[0]) if there[t] < FAR else "~" for t in range(4)]
        ranks += [sorted(set(letters)).index(x) for x in letters]
    return costs, ranks


# ------------------------------------------------------- groups in batches

def _groups(it):
    """Arrow batches of whole (conversation, part) groups, with where each begins."""
    waiting: list[pa.RecordBatch] = []
    last = None
    for b in it:
        if not b.num_rows:
            continue
        keys = list(zip(b.column("conv").to_pylist(), b.column("part").to_pylist()))
        starts = [i for i, k in enumerate(keys) if k != (keys[i - 1] if i else last)]
        last = keys[-1]
        if not starts or not waiting and len(starts) == 1:
            waiting.append(b)
            continue
        whole = pa.Table.from_batches([*waiting, b.slice(0, starts[-1])]).combine_chunks()
        before = sum(x.num_rows for x in waiting)
        yield whole, sorted({0, *(before + i for i in starts[:-1])}) if whole.num_rows else []
        waiting = [b.slice(starts[-1])]
    if waiting:
        yield pa.Table.from_batches(waiting).combine_chunks(), [0]


def _read(table: pa.Table, start: int, end: int):
    """The solver's rows of one group, with initial, fault and copies of each."""
    role, tie, copies, blank, is_open, seen_before = (
        table.column(c).slice(start, end - start).to_pylist()
        for c in ("role", "tie", "copies", "blank", "open", "seen"))
    rows, about, seen = [], [], set()
    for r, t, n, b, o, s in zip(role, tie, copies, blank, is_open, seen_before):
        duplicate = s or (r, t) in seen
        seen.add((r, t))
        fault = "blank" if b else "duplicate" if duplicate else "truncated" if o else None
        rows.append(Row(r[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        about.append((r[:1], fault, n))
    return rows, about


def _summaries(it):
    for table, starts in _groups(it):
        out = {"conv": [], "part": [], "costs": [], "ranks": [], "last": []}
        for start, end in zip(starts, [*starts[1:], table.num_rows]):
            rows, about = _read(table, start, end)
            costs, ranks = summary(rows)
            for name, value in (("conv", table.column("conv")[start].as_py()), ("part", table.column("part")[start].as_py()),
                                ("costs", costs), ("ranks", ranks), ("last", about[-1][0])):
                out[name].append(value)
        kinds = {"conv": table.schema.field("conv").type, "part": pa.int64(), "costs": pa.list_(pa.int64()),
                 "ranks": pa.list_(pa.int32()), "last": pa.string()}
        yield pa.RecordBatch.from_arrays([pa.array(out[c], kinds[c]) for c in out], list(out))


def _chain(parts):
    """The states at the cuts of one conversation, from its parts' summaries."""
    parts = parts.sort_values("part")
    costs, ranks = [list(x) for x in parts["costs"]], [list(x) for x in parts["ranks"]]
    goals = [list(END)]
    for m in reversed(costs):
        goals.insert(0, [min(m[4 * s + t] + goals[0][t] for t in range(4)) for s in range(4)])
    state, entries, exits = 0, [], []
    for m, order, now, after in zip(costs, ranks, goals, goals[1:]):
        best = [t for t in range(4) if m[4 * state + t] + after[t] == now[state]]
        entries.append(state)
        state = min(best, key=lambda t: order[4 * state + t])
        exits.append(state)
    exits[-1] = -1
    out = parts[["conv", "part"]].copy()
    out["entry"], out["exit"] = entries, exits
    out["prior"] = [None, *parts["last"][:-1]]
    return out


STEPS = ("conv {kind}, at bigint, k int, turn {turn}, action string, role string, text string, times bigint, "
         "cost bigint, fault string, illegal bigint")


def _solve(it):
    for table, starts in _groups(it):
        out = {c: [] for c in ("row", "k", "action", "role", "times", "cost", "fault", "illegal", "source")}

        def step(row, k, action, role, cost, fault=None, times=1, illegal=0, source=None):
            for name, value in zip(out, (row, k, action, role, times, cost, fault, illegal, source)):
                out[name].append(value)

        roles = table.column("role").to_pylist()
        for start, end in zip(starts, [*starts[1:], table.num_rows]):
            rows, about = _read(table, start, end)
            state, goal_state = table.column("entry")[start].as_py(), table.column("exit")[start].as_py()
            goal = END if goal_state < 0 else [0 if t == goal_state else FAR for t in range(4)]
            letters, ends = hirschberg(rows, state, list(goal))
            prior = table.column("prior")[start].as_py()
            for i, own in enumerate(letters):
                at, k = start + i, 0
                initial, fault, copies = about[i]
                for letter in own:
                    illegal = int(prior is not None and prior + initial not in LEGAL)
                    if letter == "I":
                        step(at, k, "I", EXPECTED[state], INSERT)
                        state = AFTER[state]
                    elif letter == "D":
                        step(at, k, "D", None, DELETE, fault, 1, illegal)
                    else:
                        keep = letter == "K"
                        step(at, k, letter, roles[at] if keep else EXPECTED[state],
                             (KEEP if keep else REROLE) + rows[i].extra, fault, 1, illegal, at)
                        state = NEXT[state][initial] if keep else AFTER[state]
                    k += 1
                prior = initial
                if copies > 1:  # the other copies go, each next to its like
                    again = "blank" if fault == "blank" else "duplicate"
                    step(at, k, "D", None, DELETE, again, copies - 1, copies - 1)
            if goal_state < 0:
                for k in range(END[state] // INSERT):
                    step(end - 1, 1 << 20 | k, "I", EXPECTED[state], INSERT)
                    state = AFTER[state]
        place = pa.array(out["row"], pa.int64())
        text = table.column("text").take(pa.array(out["source"], pa.int64()))
        text = pc.if_else(pc.equal(pa.array(out["action"], pa.string()), "I"), pa.scalar("", text.type), text)
        made = [table.column("conv").take(place), table.column("at").take(place), pa.array(out["k"], pa.int32()),
                table.column("turn").take(place), pa.array(out["action"], pa.string()), pa.array(out["role"], pa.string()),
                text.cast(pa.string()), *(pa.array(out[c], pa.int64()) for c in ("times", "cost")),
                pa.array(out["fault"], pa.string()), pa.array(out["illegal"], pa.int64())]
        names = ["conv", "at", "k", "turn", "action", "role", "text", "times", "cost", "fault", "illegal"]
        yield from pa.Table.from_arrays(made, names).combine_chunks().to_batches()


def repair(turns: DataFrame, copies: Column | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """The edits of every conversation, a row per edit, in the order ``conv, at, k``.

    ``action`` is K, R, D or I; K, R and I carry the ``role`` and ``text`` of
    the message that results; ``times``: a D stands for so many equal rows;
    ``cost`` is that of one; ``fault`` of the row: its first of blank, duplicate
    and truncated, or null; ``illegal``: how often its role does not follow the
    row before it. Rows are taken by turn, null turns first, ties by role and
    the text's MD5 digest. A role that begins with none of s, u and a, or is
    empty, cannot be kept. Null roles and texts count as empty, null
    conversation ids as one conversation; rows that repeat are copies, and so
    is a row with ``copies`` above one. An empty table gives no rows.
    ``ranges``: into how many ranges the rows are sorted (default: the number
    of shuffle partitions).
    """
    spark = turns.sparkSession
    find_package(spark)
    shared = Shared(spark, "repair")
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    n = copies if copies is not None else F.lit(1)
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), shown(role_col).alias("role"),
                        shown(text_col).alias("text"), n.cast("bigint").alias("copies"))
    rows = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    body = F.rtrim(F.col("text"), F.lit(SPACE_CHARS))
    rows = rows.select("conv", "turn", "role", F.md5("text").alias("tie"), "text", "copies", (body == "").alias("blank"),
                       (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("open"))
    order = ["conv", "turn", "role", "tie"]
    count = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = shared.table(rows.repartitionByRange(count, *order).sortWithinPartitions(*order)
                           .withColumn("at", F.monotonically_increasing_id())
                           .withColumn("part", F.shiftright("at", 33)), "sorted")
    # at most two parts of a range belong to conversations that are cut
    cut = sorted_.groupBy("conv").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo < hi")
    cut = shared.table(cut.select(F.col("conv").alias("cut_conv")), "cut")
    of_cut = F.col("conv").eqNullSafe(F.col("cut_conv"))
    cut_rows = shared.table(sorted_.join(cut, of_cut).drop("cut_conv"), "cut_rows")
    first = cut_rows.groupBy("conv", "role", "tie").agg(F.min("part").alias("first")).select(
        F.col("conv").alias("f_conv"), F.col("role").alias("f_role"), F.col("tie").alias("f_tie"), "first")
    cut_rows = (cut_rows.join(first, F.col("conv").eqNullSafe(F.col("f_conv")) & (F.col("role") == F.col("f_role"))
                              & (F.col("tie") == F.col("f_tie")))
                .withColumn("seen", F.col("first") < F.col("part")).drop("f_conv", "f_role", "f_tie", "first"))
    cut_rows = shared.table(cut_rows, "seen_rows")
    dealt = lambda df: df.repartition("conv", "part").sortWithinPartitions("conv", "part", "at")
    kind, turn = (rows.schema[c].dataType.simpleString() for c in ("conv", "turn"))
    slim = cut_rows.select("conv", "part", "at", "role", "tie", "copies", "blank", "open", "seen")
    sums = dealt(slim).mapInArrow(_summaries, f"conv {kind}, part bigint, costs array<bigint>, ranks array<int>, last string")
    states = shared.table(sums.groupBy("conv").applyInPandas(
        _chain, f"conv {kind}, part bigint, entry int, exit int, prior string"), "states")
    states = states.select(F.col("conv").alias("s_conv"), F.col("part").alias("s_part"), "entry", "exit", "prior")
    whole = (sorted_.join(cut, of_cut, "left_anti")
             .withColumns({"seen": F.lit(False), "entry": F.lit(0), "exit": F.lit(-1), "prior": F.lit(None).cast("string")}))
    parts = cut_rows.join(states, F.col("conv").eqNullSafe(F.col("s_conv")) & (F.col("part") == F.col("s_part")))
    return dealt(whole.unionByName(parts.drop("s_conv", "s_part"))).mapInArrow(_solve, STEPS.format(kind=kind, turn=turn))


def _digest(it):
    """One row per conversation from its edits in order; only running values are held."""
    def empty():
        return {"faults": {"blank": 0, "duplicate": 0, "truncated": 0}, "illegal": 0, "cost": 0, "audit": [],
                "turns": 0, "low": None, "high": None, "turn": None, "sha": hashlib.sha256(), "some": False}

    def row(conv, s):
        gaps = s["high"] - s["low"] + 1 - s["turns"] if s["turns"] else 0
        return (conv, gaps, *s["faults"].values(), s["illegal"], s["cost"], "".join(s["audit"]), s["sha"].hexdigest())

    now, state, done = None, None, []
    for b in it:
        cols = [b.column(c).to_pylist() for c in ("conv", "turn", "action", "role", "text", "times", "cost", "fault", "illegal")]
        for conv, turn, action, role, text, times, cost, fault, illegal in zip(*cols):
            if state is None or conv != now:
                if state is not None:
                    done.append(row(now, state))
                now, state = conv, empty()
            state["illegal"] += illegal
            state["cost"] += cost * times
            state["audit"].append(action * times)
            if fault:
                state["faults"][fault] += times
            if turn is not None and turn != state["turn"]:  # turns come in order
                state["turns"] += 1
                state["low"] = turn if state["low"] is None else state["low"]
                state["high"] = state["turn"] = turn
            if role is not None:
                state["sha"].update(f"{chr(10) * state['some']}{role}:{text}".encode("utf-8", "surrogatepass"))
                state["some"] = True
        if len(done) > 1000:
            yield _rows(done, b.schema.field("conv").type)
            done = []
        kind = b.schema.field("conv").type
    if state is not None:
        yield _rows([*done, row(now, state)], kind)


DIGEST = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def _rows(rows, kind):
    kinds = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
    names = ["conv", *(x.split()[0] for x in DIGEST.split(", "))]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def digests(steps: DataFrame) -> DataFrame:
    """``conv`` and the totals, letters and digest of each conversation's edits.

    A digest is of all messages in order, so a conversation is read as one
    sorted stream; nothing of it is held but running sums and its letters.
    """
    kind = steps.schema["conv"].dataType.simpleString()
    rows = steps.repartition("conv").sortWithinPartitions("conv", "at", "k")
    return rows.mapInArrow(_digest, f"conv {kind}, {DIGEST}")
