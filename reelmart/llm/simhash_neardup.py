"""SimHash near-duplicates by pigeonring filtering.

``fingerprints`` votes the XXH64 of every word shingle into 64 bits (Arrow
batches; the hashing of one document never leaves its row). ``links`` finds
all pairs of distinct fingerprints that differ in at most ``radius`` bits:

* The 64 bits are cut into ``radius + 1`` segments on a ring. By the
  pigeonring principle a pair within the radius has a start segment from which
  every chain of ``l`` consecutive segments differs in at most
  ``floor(l * radius / (radius + 1)) = l - 1`` bits.
* So the start segment is equal and the next differs in at most one bit, which
  leaves one of its halves equal. Start segment and half form the join key (24
  bits at radius 3), which keeps buckets small where a 16-bit block would not.
* A candidate must then pass every chain budget before the full Hamming
  check, all inside the join condition.

``near_duplicates`` raises the radius step by step (1, 2, ... radius) and joins
only across the classes found so far. A group of thousands of near copies has
collapsed into a class before the wide radius is tried, so its members never
meet pair by pair, and every link still ends up inside one component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmart.llm._common import Shared, pieces, text_of
from reelmart.llm.components import components

BITS = 64
SEED = 42


def fingerprint_of(text: str, shingle: int = 3) -> int:
    """The fingerprint of one text, as an unsigned 64-bit integer.

    A-Z are lower-cased, words are runs without separators, shingles repeat as
    often as they occur. Fewer words than ``shingle``: the whole sequence is
    one shingle. No words: 0. A bit is set if over half the hashes set it.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII only
    if not words:
        return 0
    k = min(shingle, len(words))
    body = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - k + 1].tolist()
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter((h(body[a:b], SEED) for a, b in zip(starts, ends[k - 1:].tolist())),
                         np.uint64, len(starts))
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3) -> DataFrame:
    """``id, fp`` (fp: the fingerprint's bits as a signed long) per row."""
    def batches(it):
        for b in pieces(it):
            fps = [fingerprint_of(t or "", shingle) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
            .mapInArrow(batches, f"id {kind}, fp bigint"))


def _segments(radius: int) -> list[tuple[int, int]]:
    """(first bit, width) of the radius + 1 segments."""
    m = radius + 1
    cuts = [BITS * i // m for i in range(m + 1)]
    return [(cuts[i], cuts[i + 1] - cuts[i]) for i in range(m)]


def _field(x: str, at: int, width: int) -> str:
    return f"(shiftrightunsigned({x}, {at}) & {(1 << width) - 1}L)"


def _tables(radius: int) -> list[tuple[int, tuple[int, int]]]:
    """(start segment, equal half of the next segment) per table."""
    seg = _segments(radius)
    out = []
    for i in range(len(seg)):
        at, width = seg[(i + 1) % len(seg)]
        out += [(i, (at, width // 2)), (i, (at + width // 2, width - width // 2))]
    return out


def _chain_mask(radius: int, start: int, length: int) -> int:
    """The bits of ``length`` segments from ``start`` on, as a signed long."""
    seg = _segments(radius)
    bits = 0
    for j in range(length):
        at, width = seg[(start + j) % len(seg)]
        bits |= ((1 << width) - 1) << at
    return bits - (1 << 64) if bits >> 63 else bits


def links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """Pairs ``u, v`` of nodes in different classes within ``radius`` bits.

    ``fps``: ``fp, node, class``, one row per distinct ``fp``. ``radius`` is 1
    to 15. A pair may appear once per table that its chains allow.
    """
    if not 1 <= radius <= 15:
        raise ValueError("radius must be between 1 and 15")
    seg, tables = _segments(radius), _tables(radius)
    m = len(seg)
    key = "CASE t " + " ".join(
        f"WHEN {t} THEN xxhash64({t}, {_field('fp', *seg[i])}, {_field('fp', *half)})"
        for t, (i, half) in enumerate(tables)) + " END"
    rows = (fps.withColumn("t", F.explode(F.array(*[F.lit(t) for t in range(len(tables))])))
            .withColumn("key", F.expr(key)))
    chains = []
    for l in range(1, m + 1):  # l = m is the full Hamming check
        mask = "CASE a.t " + " ".join(f"WHEN {t} THEN {_chain_mask(radius, i, l)}L"
                                      for t, (i, _) in enumerate(tables)) + " END"
        chains.append(f"bit_count((a.fp ^ b.fp) & {mask}) <= {l * radius // m}")
    on = "a.key = b.key AND a.t = b.t AND a.fp < b.fp AND a.class <> b.class AND " + \
        " AND ".join(chains)
    return (rows.alias("a").join(rows.alias("b"), F.expr(on))
            .select(F.col("a.node").alias("u"), F.col("b.node").alias("v")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row per input row: ``id, fp, component``.

    ``component`` is the smallest id reachable over links of at most ``radius``
    bits, the row's own id included. Null texts count as empty; all empty texts
    have fingerprint 0 and link. Rows that repeat an id share that id's links;
    a row without an id links nothing and has a null component unless its
    fingerprint also occurs with an id. An empty table gives no rows.
    """
    shared = Shared(docs.sparkSession, "simhash")
    fps = shared.table(fingerprints(docs, id_col, text_col, shingle), "fps")
    # one node per distinct fingerprint: copies of any number meet only here
    nodes = shared.table(fps.groupBy("fp").agg(F.min("id").alias("node"))
                         .filter("node is not null"), "nodes")
    classes = nodes.withColumn("class", F.col("node"))
    found = None
    for r in range(1, radius + 1):
        new = shared.table(links(classes, r), f"links{r}")
        edges = new if found is None else found.unionByName(new)
        grown = shared.table(components(edges, shared), f"classes{r}")
        # a class is a star: that is all the next step needs of it
        found = grown.select(F.col("node").alias("u"), F.col("component").alias("v"))
        classes = (nodes.join(grown, "node", "left")
                   .select("fp", "node", F.coalesce("component", "node").alias("class")))
        shared.drop(new)
    return (fps.join(classes.select("fp", F.col("class").alias("component")), "fp", "left")
            .select("id", "fp", "component"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with one document of each near-duplicate class, unchanged.

    The row with the class's smallest id stays; of rows that repeat an id, one.
    A row without an id stays only where no row of its fingerprint has one, one
    row per text.
    """
    shared = Shared(docs.sparkSession, "simhash")
    found = shared.table(near_duplicates(docs, id_col, text_col, shingle, radius), "found")
    near = "__near_id"  # a name that the documents do not have
    gone = found.filter("id <> component").select(F.col("id").alias(near)).distinct()
    many = shared.table(found.filter("id IS NOT NULL").groupBy(F.col("id").alias(near))
                        .agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(near), "many")
    key = F.col(id_col)
    kept = docs.filter(key.isNotNull()).join(gone, key == F.col(near), "left_anti")
    if not many.isEmpty():
        kept = kept.join(many, key == F.col(near), "left_anti").unionByName(
            kept.join(many, key == F.col(near), "left_semi").dropDuplicates([id_col]))
    if not found.filter("id IS NULL AND component IS NULL").isEmpty():
        loose, text = docs.filter(key.isNull()), text_of(text_col)
        prints = fingerprints(loose.select(F.md5(text).alias("id"), text.alias("text")), "id", "text", shingle)
        alone = prints.join(found.filter("component IS NULL").select("fp").distinct(), "fp", "left_semi").select(
            F.col("id").alias(near)).distinct()
        kept = kept.unionByName(loose.join(alone, F.md5(text) == F.col(near), "left_semi").dropDuplicates([text_col]))
    return kept
