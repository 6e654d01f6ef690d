"""Tool-call linking for chat data.

Calls and results meet by hash join on (conversation, call identifier). Calls
are put in topological order: a call may name the calls whose results it uses,
and its place is after all of its predecessors. Arguments are checked against
the tools' declared parameters, and every call is serialised with its result
as canonical JSON (keys sorted at every level, no spaces, numbers in shortest
form), one line per call.

Order is given by sort columns, not by numbering a conversation's rows, so a
conversation with a third of all messages is never gathered. Dependencies are
a table of edges that shrinks in rounds of one join: an edge to a call whose
place is known becomes a number, an edge to a call with one predecessor jumps
on to that predecessor, and edges that then end at the same call merge. Chains
and lone joins of several results need a logarithm of their length in rounds;
only layer upon layer of calls that all wait for several others need a round
each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart.llm._common import Shared

#: No path is as long; lengths on a cycle stop doubling here.
ENDLESS = 1 << 60

#: JSON Schema type names by the type of a parsed JSON value.
TYPES = {"BIGINT": "integer", "DOUBLE": "number", "DECIMAL": "number", "STRING": "string",
         "BOOLEAN": "boolean", "VOID": "null", "ARRAY": "array", "OBJECT": "object"}


def json_type(value: Column) -> Column:
    """The JSON Schema type name of a VARIANT value."""
    name = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    out = F.lit("unknown")
    for kind, json in TYPES.items():
        out = F.when(name == kind, json).otherwise(out)
    return out


def extract(messages: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
            text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(calls, results) from messages whose text is JSON.

    A message ``{"tool_calls": [{"id", "name", "arguments", "after"}]}`` makes
    calls, ``{"tool_call_id", "content"}`` a result. Arguments may be an object
    or the text of one, ``after`` one identifier or a list of them. Other
    messages, also broken JSON, make neither.
    """
    call = "struct<id:string,name:string,arguments:string,after:variant>"
    parsed = messages.select(
        F.col(id_col).alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"),
        F.from_json(F.col(text_col), f"tool_calls array<{call}>, tool_call_id string, content string").alias("m"))
    calls = (parsed.select("conv_id", "turn", F.explode("m.tool_calls").alias("c"))
             .select("conv_id", "turn", F.col("c.id").alias("call_id"), "c.name", "c.arguments",
                     F.when(json_type(F.col("c.after")) == "array",
                            F.try_variant_get("c.after", "$", "array<string>"))
                     .otherwise(F.array(F.try_variant_get("c.after", "$", "string"))).alias("after")))
    results = parsed.filter("m.tool_call_id IS NOT NULL").select(
        "conv_id", "turn", F.col("m.tool_call_id").alias("call_id"), "m.content")
    return calls, results


def _places(calls: DataFrame, shared: Shared) -> DataFrame:
    """``conv_id, call_id, sort_turn, depth, cyclic`` for unique calls.

    ``sort_turn``: the latest turn of the call and all its predecessors,
    ``depth``: the calls on its longest path of predecessors. Ordering by
    (sort_turn, depth) puts every call after its predecessors. Calls on a
    cycle, or after one, keep their own turn.

    A call's terms are rows (``next``, ``top``, ``hops``): it lies ``hops``
    after ``next``, no earlier than ``top``; without ``next`` the term is final.
    Each round settles at least one call unless all that are left wait for a
    cycle, and never makes more terms with a ``next`` than there were.
    """
    node = ["conv_id", "call_id"]
    edges = calls.select(*node, "turn", F.explode("after").alias("next")).distinct().alias("e").join(
        calls.select(*node).alias("p"),
        F.col("e.conv_id").eqNullSafe(F.col("p.conv_id")) & (F.col("e.next") == F.col("p.call_id")), "left_semi")
    start = calls.select(*node, F.lit(None).cast("string").alias("next"), F.col("turn").alias("top"),
                         F.lit(0).cast("bigint").alias("hops"))
    terms = shared.table(start.unionByName(edges.select(
        *node, "next", F.col("turn").alias("top"), F.lit(1).cast("bigint").alias("hops"))), "terms")
    final = F.col("next").isNull()
    waiting = None
    while True:
        state = shared.table(terms.groupBy(*node).agg(
            F.count("next").alias("n"), F.max(F.when(final, F.col("top"))).alias("top"),
            F.max(F.when(final, F.col("hops"))).alias("hops"),
            F.max(F.when(~final, F.struct("next", "top", "hops"))).alias("on")), "state")
        left = state.filter("n > 0").count()
        if left in (0, waiting):
            break
        waiting = left
        e, f = terms.filter("next IS NOT NULL").alias("e"), state.alias("f")
        term = lambda next_, top, hops: F.struct(
            next_.alias("next"), F.greatest("e.top", top).alias("top"),
            F.least(F.col("e.hops") + F.col(hops), F.lit(ENDLESS)).alias("hops"))
        known = term(F.lit(None).cast("string"), "f.top", "f.hops")
        on = term(F.col("f.on.next"), "f.on.top", "f.on.hops")
        moved = e.join(f, F.col("e.conv_id").eqNullSafe(F.col("f.conv_id"))
                       & (F.col("e.next") == F.col("f.call_id"))).select(
            "e.conv_id", "e.call_id", F.explode(
                F.when(F.col("f.n") == 0, F.array(known)).when(F.col("f.n") == 1, F.array(known, on))
                .otherwise(F.array(F.struct("e.next", "e.top", "e.hops")))).alias("t")).select(*node, "t.*")
        own = state.select(*node, F.lit(None).cast("string").alias("next"), "top", "hops")
        new = shared.table(moved.unionByName(own).groupBy(*node, "next").agg(
            F.max("top").alias("top"), F.max("hops").alias("hops")), "terms")
        shared.drop(terms, state)
        terms = new
    cyclic = F.col("n") > 0
    own_turn = calls.select(F.col("conv_id").alias("o_conv"), F.col("call_id").alias("o_id"), "turn")
    return state.join(own_turn, F.col("conv_id").eqNullSafe(F.col("o_conv")) & (F.col("call_id") == F.col("o_id"))).select(
        *node, F.when(cyclic, F.col("turn")).otherwise(F.col("top")).alias("sort_turn"),
        F.when(cyclic, 0).otherwise(F.col("hops")).cast("bigint").alias("depth"), cyclic.alias("cyclic"))


def _problems(arguments: Column, params: Column, known: Column) -> Column:
    """Sorted names of what is wrong with the arguments ([] if nothing).

    ``params``: map of parameter to struct(type, required).
    """
    given = F.try_variant_get(arguments, "$", "map<string,variant>")
    misfit = F.transform(F.filter(F.map_entries(given), lambda e: F.map_contains_key(params, e["key"]) & ~(
        (json_type(e["value"]) == F.element_at(params, e["key"])["type"])
        | ((json_type(e["value"]) == "integer") & (F.element_at(params, e["key"])["type"] == "number")))),
        lambda e: F.concat(F.lit("type:"), e["key"]))
    extra = F.transform(F.filter(F.map_keys(given), lambda k: ~F.map_contains_key(params, k)),
                        lambda k: F.concat(F.lit("unknown:"), k))
    missing = F.transform(F.filter(F.map_entries(params), lambda e: e["value"]["required"]
                                   & ~F.map_contains_key(given, e["key"])),
                          lambda e: F.concat(F.lit("missing:"), e["key"]))
    return (F.when(~known, F.array(F.lit("tool")))
            .when(given.isNull(), F.array(F.lit("not an object")))
            .otherwise(F.array_sort(F.concat(misfit, extra, missing))))


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call and per result without a call.

    ``calls``: conv_id, turn, call_id, name, arguments (JSON text), after (the
    identifiers of the calls it depends on as an array, or one as a string;
    nulls and repeats among them count for nothing). ``results``: conv_id, turn,
    call_id, content. ``schemas``: name, param, type, required; a parameter
    without a name declares a tool without parameters.

    Columns: ``conv_id, call_id, sort_turn, depth, turn, status, n_results,
    problems, message``; rows sorted by (sort_turn, depth, turn, call_id) are in
    topological order within a conversation. ``status`` is linked, pending (no
    result), cyclic, duplicate (its identifier belongs to an earlier call), no
    id, or orphan (a result without its call). The earliest call of an
    identifier owns its results, and its earliest result is serialised; equal
    rows count as duplicates of each other. A dependency on an unknown call is
    none. ``problems`` names what fails the schema. Broken argument text is
    kept as ``raw_arguments``. A null conversation is a conversation; a null
    turn sorts first. Empty tables give no rows.
    """
    shared = Shared(calls.sparkSession, "calls")
    key = ["conv_id", "call_id"]
    after = F.col("after") if calls.schema["after"].dataType.typeName() == "array" else F.array("after")
    calls = calls.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "call_id", "name", "arguments",
                         after.cast("array<string>").alias("after"))
    named = calls.filter("call_id IS NOT NULL").groupBy(*calls.columns).agg(F.count(F.lit(1)).alias("same"))
    own = shared.table(named.groupBy(*key).agg(
        F.min(F.struct("turn", "name", "arguments", "after")).alias("c")).select(*key, "c.*"), "own")
    match = lambda a, b, cols: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols]

    got = results.filter("call_id IS NOT NULL").groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_results"),
        F.min(F.struct(F.col("turn").cast("bigint").alias("turn"), "content"))["content"].alias("content"))
    placed = _places(own, shared)
    linked = (own.alias("o").join(got.alias("g"), match("o", "g", key), "left")
              .join(placed.alias("p"), match("o", "p", key))
              .select("o.*", "g.n_results", "g.content", "p.sort_turn", "p.depth",
                      F.when(F.col("cyclic"), "cyclic").when(F.col("n_results").isNull(), "pending")
                      .otherwise("linked").alias("status")))
    # every copy of a call but the first, and calls without an identifier
    row = ["conv_id", "call_id", "turn", "name", "arguments", "after"]
    copies = named.alias("n").join(own.select(*row, F.lit(1).alias("owner")).alias("o"), match("n", "o", row), "left") \
        .select(*[F.col(f"n.{c}") for c in row],
                F.explode(F.expr("array_repeat('duplicate', cast(same - coalesce(owner, 0) as int))")).alias("status"))
    loose = copies.unionByName(calls.filter("call_id IS NULL").withColumn("status", F.lit("no id"))) \
        .withColumns({"sort_turn": F.col("turn"), "depth": F.lit(0).cast("bigint")})
    every = linked.unionByName(loose, allowMissingColumns=True)

    tool = schemas.groupBy("name").agg(F.map_from_entries(F.collect_set(F.when(
        F.col("param").isNotNull(), F.struct("param", F.struct("type", F.coalesce("required", F.lit(False)).alias("required"))))
        )).alias("params")).withColumnRenamed("name", "tool")
    every = every.join(tool, F.col("name") == F.col("tool"), "left").withColumn("args", F.try_parse_json("arguments"))
    problems = _problems(F.col("args"), F.col("params"), F.col("tool").isNotNull())
    message = F.to_json(F.struct(
        F.col("args").alias("arguments"), "call_id", "conv_id", "name",
        F.when(F.col("args").isNull(), F.col("arguments")).alias("raw_arguments"),
        F.col("content").alias("result"), "turn"))
    out = every.select("conv_id", "call_id", "sort_turn", "depth", "turn", "status",
                       F.coalesce("n_results", F.lit(0)).cast("bigint").alias("n_results"),
                       F.array_join(problems, ",").alias("problems"), message.alias("message"))
    orphans = results.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "call_id", "content").alias("r").join(
        own.alias("o"), match("r", "o", ["conv_id"]) + [F.col("r.call_id") == F.col("o.call_id")], "left_anti")
    orphans = orphans.select(
        "conv_id", "call_id", F.col("turn").alias("sort_turn"), F.lit(0).cast("bigint").alias("depth"), "turn",
        F.lit("orphan").alias("status"), F.lit(1).cast("bigint").alias("n_results"), F.lit("").alias("problems"),
        F.to_json(F.struct("call_id", "conv_id", F.col("content").alias("result"), "turn")).alias("message"))
    return out.unionByName(orphans)
