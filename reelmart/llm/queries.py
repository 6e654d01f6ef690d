"""The registered queries of this subpackage: thin bindings to the given tables.

Each query applies its operator with production parameters to the whole
table and derives the digest columns from the operator's own output.
``ORACLE`` holds DuckDB SQL where SQL can express the result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmart.llm._common import find_package, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            find_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return put


@query("op4_simhash_fingerprint")
def op4_simhash_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts.

    ``n_within``: for every id divisible by 50, how many other documents lie
    within 6 bits (null for the rest).
    """
    from reelmart.llm import fingerprint as f
    from reelmart.llm._common import Shared
    out = Shared(spark, "prints").table(f.compare_next(table(spark, sf_dir, "documents")), "prints")
    asked = F.col("id") % 50 == 0
    copies = out.groupBy("fp1", "fp2").agg(F.count(F.lit(1)).alias("n"))
    hits = f.within_radius(out.filter(asked), copies, radius=6, spare=2)
    copies = copies.withColumnsRenamed({"fp1": "hit1", "fp2": "hit2"})
    near = (hits.join(copies, ["hit1", "hit2"]).groupBy("fp1", "fp2")
            .agg(F.sum("n").alias("n_all")))
    return out.join(near, ["fp1", "fp2"], "left").select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256",
        f.hex128("fp2", "fp1").alias("fingerprint"),
        f.hex128("edited_fp2", "edited_fp1").alias("edited_fingerprint"),
        "near_edited", "near_next",
        F.when(asked, F.col("n_all") - 1).alias("n_within"))


@query("op5_pii")
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    from reelmart.llm import pii
    out = pii.find(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_email", "n_ip", "n_card", "n_phone",
                      "base_sha256", "spans")


#: Rules of the secret scan that were raised after the earlier versions were scanned.
RAISED = ("jwt", "hub_token")


@query("op6_secret_ledger")
def op6_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document and in its version before the last line came.

    The ledger first meets the earlier versions (the text up to its last line
    feed; without one, the whole text) under the rules' previous versions, then
    the documents under the present ones: new texts are scanned by all rules,
    texts seen before by the raised rules only. ``n_earlier``: findings of the
    earlier version by the rules that were not raised since.
    """
    from dataclasses import replace

    from reelmart.llm import secrets
    from reelmart.llm._common import Shared
    shared = Shared(spark, "ledger")
    ledger = secrets.Ledger(spark, shared.root)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.when(F.instr("text", "\n") > 0, F.expr(
        "left(text, length(text) - length(substring_index(text, '\n', -1)) - 1)"))
        .otherwise(F.col("text")).alias("earlier"))
    before = tuple(replace(r, version=r.version - 1) if r.kind in RAISED else r for r in secrets.RULES)
    secrets.scan(docs, ledger, before, text_col="earlier")
    secrets.scan(docs, ledger)
    same = tuple(r for r in secrets.RULES if r.kind not in RAISED)
    old = shared.table(secrets.totals(ledger, same).withColumnRenamed("blob", "earlier_blob"), "earlier")
    out = secrets.report(docs.withColumn("earlier_blob", secrets.blob_of("earlier")), ledger, keep=("earlier_blob",))
    return out.join(old, "earlier_blob", "left").select(
        F.col("id").alias("doc_id"), "n_assign", "n_access", "n_hex", "base_sha256", "spans",
        F.coalesce("n_findings", F.lit(0).cast("bigint")).alias("n_earlier"))


@query("op7_byte_bpe")
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every document and its decoding."""
    import public_tokenizers

    from reelmart.llm import bpe
    out = bpe.round_trip(table(spark, sf_dir, "documents"),
                         public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                         public_tokenizers.PATTERN)
    return out.withColumnRenamed("id", "doc_id")


@query("op8_simhash_neardup")
def op8_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    from reelmart.llm import simhash_neardup as s
    out = s.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return out.select(F.col("id").alias("doc_id"),
                      F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      F.col("component").alias("component_id"))


@query("op10_curriculum_mix", r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM d GROUP BY source),
o AS (
  SELECT *, source_size::HUGEINT * 4 *
              sum(w) OVER (ORDER BY source_size / w, source NULLS LAST
                           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
            <= w * (3 * sum(source_size) OVER () - 4 * coalesce(sum(source_size) OVER (
                 ORDER BY source_size / w, source NULLS LAST
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS filled
  FROM s),
t AS (
  SELECT source, source_size,
         CASE WHEN filled THEN (2 * source_size)::DOUBLE ELSE w::DOUBLE * (
           (3 * sum(source_size) OVER () - 4 * coalesce(sum(source_size) FILTER (filled) OVER (), 0))::DOUBLE
           / (2 * sum(w) FILTER (NOT filled) OVER ())::DOUBLE) END AS target
  FROM o),
c AS (
  SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY h, size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins
  FROM d)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, floor(target)::BIGINT - begins))
        + greatest(0, least(size, floor(target)::BIGINT - begins - source_size)))::BIGINT AS taken
FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source
""")
def op10_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents, in the order of their training positions."""
    from reelmart.llm import mixing
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@query("op9_ordinal_quality")
def op9_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade, tail probability and decision for every document."""
    from reelmart.llm import quality as q
    docs = table(spark, sf_dir, "documents")
    model = q.fit(docs, q.grades_of(table(spark, sf_dir, "labels")), grades=3)
    return q.score(docs, model, grades=3).select(
        F.col("id").alias("doc_id"), "expected_grade", F.get("tails", F.lit(1)).alias("p_good"),
        (F.get("tails", F.lit(1)) >= 0.5).alias("kept"))


@query("op2_fuzzy_lines")
def op2_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and decision of every line that has a word."""
    from reelmart.llm import line_dedup as d
    return d.line_classes(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), F.col("pos").cast("bigint").alias("line_no"),
        F.col("first_id").alias("first_doc_id"), F.col("first_pos").cast("bigint").alias("first_line_no"), "kept")


@query("op3_rotated_codes")
def op3_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and class of every embedding, whatever its label."""
    from reelmart.llm import embedding_neardup as e
    return e.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95).select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").cast("bigint").alias("component_id"), "kept")


#: Declared parameters of the tools that the conversations are read as using.
TOOLS = [("search", "query", "string", True), ("search", "limit", "integer", False),
         ("search", "exact", "boolean", False),
         ("fetch", "query", "string", True), ("fetch", "limit", "number", True),
         ("note", "query", "string", False), ("note", "exact", "boolean", True)]


@query("op1_tool_calls", r"""
WITH RECURSIVE q AS (
  SELECT *, length(coalesce(text, '')) AS n, 'c' || conv_id || '-' || turn AS id
  FROM conversations WHERE role = 'user'),
p AS (
  SELECT conv_id, turn, 0 AS depth FROM q
  UNION
  SELECT q.conv_id, q.turn, p.depth + 1
  FROM p JOIN q ON q.conv_id = p.conv_id
       AND (q.turn = p.turn + 2 OR (q.n % 13 < 3 AND q.turn IN (p.turn + 4, p.turn + 6)))),
u AS (
  SELECT q.*, (SELECT max(depth) FROM p WHERE p.conv_id = q.conv_id AND p.turn = q.turn) AS depth,
         CASE WHEN n % 17 = 0 THEN 'other' ELSE ['search', 'fetch', 'note'][n % 3 + 1] END AS name,
         n % 5 = 0 AS worded, n % 7 = 0 AS silent, n % 11 = 0 AS broken, to_json(coalesce(text, '')) AS words
  FROM q),
a AS (SELECT conv_id, 'c' || conv_id || '-' || (turn - 1) AS id, turn, text
      FROM conversations WHERE role = 'assistant'),
c AS (
  SELECT u.*, a.text AS result, a.id IS NOT NULL AS answered,
         CASE WHEN broken THEN 'not an object' WHEN name = 'other' THEN 'tool' ELSE concat_ws(',',
           CASE WHEN name <> 'note' AND silent THEN 'missing:query' END,
           CASE WHEN name <> 'note' AND worded THEN 'type:limit' END,
           CASE name WHEN 'fetch' THEN 'unknown:exact' WHEN 'note' THEN 'unknown:limit' END) END AS problems
  FROM u LEFT JOIN a USING (conv_id, id))
SELECT conv_id, id AS call_id, turn AS sort_turn, depth::BIGINT AS depth, turn,
       CASE WHEN answered THEN 'linked' ELSE 'pending' END AS status, answered::BIGINT AS n_results,
       CASE WHEN name = 'other' THEN 'tool' ELSE problems END AS problems,
       '{' || CASE WHEN broken THEN '' ELSE '"arguments":{"exact":true,"limit":'
         || CASE WHEN worded THEN '"' || n || '"' ELSE n::VARCHAR END
         || CASE WHEN silent THEN '' ELSE ',"query":' || words END || '},' END
       || '"call_id":"' || id || '","conv_id":' || conv_id || ',"name":"' || name || '"'
       || CASE WHEN broken THEN ',"raw_arguments":"{limit"' ELSE '' END
       || CASE WHEN result IS NULL THEN '' ELSE ',"result":' || to_json(result) END
       || ',"turn":' || turn || '}' AS message
FROM c
UNION ALL
SELECT a.conv_id, a.id, a.turn, 0, a.turn, 'orphan', 1, '',
       '{"call_id":"' || a.id || '","conv_id":' || a.conv_id
       || CASE WHEN a.text IS NULL THEN '' ELSE ',"result":' || to_json(a.text) END || ',"turn":' || a.turn || '}'
FROM a ANTI JOIN u USING (conv_id, id)
""")
def op1_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tool calls and results read from every conversation.

    A user turn is read as a message with a call that depends on the user turn
    two before it, by its length also on those four and six before, an
    assistant turn as one with the result of the turn before it. Arguments come
    from the text; some lack a parameter, have a wrong type or are broken, by
    the text's length.
    """
    from reelmart.llm import tool_calls as t
    n = F.length(F.coalesce("text", F.lit("")))
    quoted = F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("query")))
    turns = table(spark, sf_dir, "conversations").withColumn("q", quoted)
    call_id = lambda k: F.concat(F.lit("c"), "conv_id", F.lit("-"), F.col("turn") - k)
    limit = F.when(n % 5 == 0, F.concat(F.lit('"'), n, F.lit('"'))).otherwise(n.cast("string"))
    arguments = F.when(n % 11 == 0, F.lit("{limit")).otherwise(F.concat(
        F.when(n % 7 == 0, F.lit("{")).otherwise(F.concat(F.expr("left(q, length(q) - 1)"), F.lit(", "))),
        F.lit('"limit": '), limit, F.lit(', "exact": true}')))
    call = F.struct(
        call_id(0).alias("id"),
        F.when(n % 17 == 0, "other").otherwise(F.element_at(F.lit(["search", "fetch", "note"]), n % 3 + 1)).alias("name"),
        arguments.alias("arguments"),
        F.when(n % 13 < 3, F.array(call_id(2), call_id(4), call_id(6))).otherwise(F.array(call_id(2))).alias("after"))
    message = F.when(F.col("role") == "user", F.to_json(F.struct(F.array(call).alias("tool_calls")))).when(
        F.col("role") == "assistant", F.to_json(F.struct(call_id(1).alias("tool_call_id"), F.col("text").alias("content"))))
    calls, results = t.extract(turns.select("conv_id", "turn", message.alias("text")))
    tools = spark.createDataFrame(TOOLS, "name string, param string, type string, required boolean")
    return t.link(calls, results, tools)


@query("op11_conversation_repair", r"""
WITH RECURSIVE
t AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                        lambda c: ascii(c)::BIGINT) AS bytes
  FROM conversations),
k AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda crc, b:
           list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, i:
             xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))), 4294967295::BIGINT) % 20 AS kind
  FROM t),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM k),
n AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS c,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), text) AS i FROM d),
f AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
         lag(c) OVER (PARTITION BY conv_id ORDER BY i) AS prior
  FROM n),
ins(s, s2, cost, letters, made) AS (VALUES
  (0, 0, 0, '', ''), (0, 2, 5, 'I', 'user:'), (0, 3, 10, 'II', E'user:\nassistant:'),
  (1, 1, 0, '', ''), (1, 2, 5, 'I', 'user:'), (1, 3, 10, 'II', E'user:\nassistant:'),
  (2, 2, 0, '', ''), (2, 3, 5, 'I', 'assistant:'), (2, 2, 10, 'II', E'assistant:\nuser:'),
  (3, 3, 0, '', ''), (3, 2, 5, 'I', 'user:'), (3, 3, 10, 'II', E'user:\nassistant:')),
act(s, letter, c, t, cost, role) AS (VALUES
  (0, 'K', 's', 1, 0, NULL), (0, 'K', 'u', 2, 0, NULL), (1, 'K', 'u', 2, 0, NULL), (2, 'K', 'a', 3, 0, NULL),
  (3, 'K', 'u', 2, 0, NULL), (0, 'R', NULL, 2, 1, 'user'), (1, 'R', NULL, 2, 1, 'user'), (2, 'R', NULL, 3, 1, 'assistant'),
  (3, 'R', NULL, 2, 1, 'user'), (0, 'D', NULL, 0, 2, NULL), (1, 'D', NULL, 1, 2, NULL), (2, 'D', NULL, 2, 2, NULL),
  (3, 'D', NULL, 3, 2, NULL)),
way AS (
  SELECT ins.s, a.letter, a.c, a.t, ins.cost + a.cost AS cost, ins.letters || a.letter AS letters, ins.made, a.role
  FROM ins JOIN act a ON a.s = ins.s2),
p(conv_id, i, s, best) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 0, {'cost': 0::BIGINT, 'audit': '', 'made': ''} FROM conversations
  UNION ALL
  SELECT p.conv_id, f.i, w.t, min({
           'cost': p.best.cost + w.cost + CASE WHEN f.fault = 'truncated' AND w.letter <> 'D' THEN 5 ELSE 0 END,
           'audit': p.best.audit || w.letters,
           'made': concat_ws(E'\n', nullif(p.best.made, ''), nullif(w.made, ''),
                             CASE WHEN w.letter <> 'D' THEN coalesce(w.role, f.role) || ':' || f.text END)})
  FROM p JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1
  JOIN way w ON w.s = p.s AND (w.letter = 'D' OR f.fault NOT IN ('blank', 'duplicate')) AND (w.c IS NULL OR w.c = f.c)
  GROUP BY p.conv_id, f.i, w.t),
facts AS (
  SELECT conv_id, count(*) AS rows, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (prior IS NOT NULL AND prior || c NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id),
done AS (
  SELECT p.conv_id, min({'cost': p.best.cost + [0, 10, 5, 0][p.s + 1], 'audit': p.best.audit || ['', 'II', 'I', ''][p.s + 1],
           'made': concat_ws(E'\n', nullif(p.best.made, ''),
                             [NULL, E'user:\nassistant:', 'assistant:', NULL][p.s + 1])}) AS best
  FROM p LEFT JOIN facts x ON x.conv_id IS NOT DISTINCT FROM p.conv_id
  WHERE p.i = coalesce(x.rows, 0) GROUP BY p.conv_id)
SELECT done.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, best.cost AS cost, best.audit AS audit, sha256(best.made) AS repaired_sha256
FROM done LEFT JOIN facts x ON x.conv_id IS NOT DISTINCT FROM done.conv_id
""")
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every damaged conversation."""
    from reelmart.llm import conversation_repair as c
    turns = table(spark, sf_dir, "conversations")
    done = c.digests(c.repair(c.damage(turns), F.col("copies")))
    every = turns.select("conv_id").distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(done, F.col("conv_id").eqNullSafe(F.col("conv")), "left").select(
        "conv_id", *[F.coalesce(x, F.lit(0).cast("bigint")).alias(x) for x in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


@query("op12_hard_negatives", r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, list_dot_product(a.q, v.q)::BIGINT AS score
  FROM v a JOIN v ON a.vec_id <> v.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
""")
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive among all embeddings."""
    from reelmart.llm import hard_negatives as h
    rows = h.scaled(table(spark, sf_dir, "embeddings"))
    rows = rows.withColumn("label", F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return h.mine(rows, F.col("id") % 100 == 0)


@query("op13_decontaminate", r"""
WITH b AS (
  SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
g AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
        FROM b WHERE len(w) > 0)),
d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
q AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n)),
h AS (SELECT r, n, i, gram FROM q WHERE gram IN (SELECT gram FROM g)),
c AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM h) GROUP BY r),
o AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM h JOIN g USING (gram)) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN o USING (r)
""")
def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    from reelmart.llm import decontaminate as d
    found = d.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))
