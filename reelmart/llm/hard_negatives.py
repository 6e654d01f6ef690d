"""Hard-negative mining by a BOND vertical scan over blocks of vectors.

Every anchor meets every block of rows, both dealt out evenly by a hash, so a
label or a vector that a third of all rows share makes no cell larger. In a
cell the rows lie by dimension (one array per component). An anchor reads the
dimensions in the order of its own components, largest magnitude first. After
each few dimensions the smallest and largest contribution that the unread ones
can still make bound every candidate's score, and a candidate leaves the bitmap
once its bounds exclude it; the scores of those left at the end are exact.

The first scan finds the positives: a candidate goes when its upper bound is
below the lower bounds of enough others. The second scan searches the windows
that the positives' scores set: a candidate goes when its bounds miss every
window, or when enough candidates are certain to lie in the window and above
it. Each scan returns its few best per block, which Spark merges per anchor.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelmart.llm._common import Shared

#: Rows of a block and anchors of a chunk, on average: a cell is one of each.
ROWS, ANCHORS = 4096, 1024
#: Dimensions read between two looks at the bitmap.
STEP = 8
NONE = np.iinfo(np.int64).max


def scaled(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
           scale: int = 256) -> DataFrame:
    """``id, label, q``: the floors of ``scale`` times each component, as double.

    Rows with a null label, a null vector or a null or non-finite component are
    left out, and so are rows with a component so large that a score might not
    fit into a long (about 2^28 after scaling at 64 dimensions).
    """
    vec = F.col(vec_col).cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.filter(F.col(label_col).isNotNull() & vec.isNotNull() & ~F.exists(vec, bad))
    rows = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).alias("label"),
                       F.transform(vec, lambda x: F.floor(x * scale)).alias("q"))
    most = F.least(F.lit(2.0 ** 31 - 1), F.sqrt(F.lit(2.0 ** 63) / F.greatest(F.size("q"), F.lit(1))) - 1)
    return (rows.filter(F.forall("q", lambda x: (x < most) & (x > -most)))
            .select("id", "label", F.col("q").cast("array<int>").alias("q")))


def scan(anchor: np.ndarray, by_dim: np.ndarray, low: np.ndarray, high: np.ndarray, alive: np.ndarray, keep):
    """``(rows, scores)`` of the candidates that ``keep`` leaves, scores exact.

    ``by_dim``: components of the block, a line per dimension; ``low``/``high``:
    their bounds; ``alive``: the candidate bitmap; ``keep(lower, upper)`` tells
    which candidates stay.
    """
    order = np.argsort(-np.abs(anchor), kind="stable")
    a, lo, hi = anchor[order], low[order], high[order]
    least, most = np.where(a >= 0, a * lo, a * hi), np.where(a >= 0, a * hi, a * lo)
    rest = lambda x: np.append(np.cumsum(x[::-1])[::-1], 0)
    least, most = rest(least), rest(most)
    rows = np.flatnonzero(alive)
    part = np.zeros(len(rows), np.int64)
    for at in range(0, max(len(a), 1), STEP):
        end = min(at + STEP, len(a))
        own = by_dim[order[at:end]]
        part += a[at:end] @ (own if len(rows) == by_dim.shape[1] else own[:, rows])
        stay = keep(part + least[end], part + most[end])
        if not stay.all():
            rows, part = rows[stay], part[stay]
        if not len(rows):
            break
    return rows, part


def _kth(x: np.ndarray, k: int) -> int:
    """The k-th largest value; the smallest long if there are fewer."""
    return int(np.partition(x, len(x) - k)[len(x) - k]) if len(x) >= k else -NONE - 1


def nearest(k: int):
    """Keeps what may be among the ``k`` best."""
    return lambda lower, upper: upper >= _kth(lower, k)


def in_windows(windows: list[tuple[int, int]], k: int):
    """Keeps what may be among the ``k`` best of a window (ends included)."""
    def keep(lower, upper):
        stay = np.zeros(len(lower), bool)
        for a, b in windows:
            sure = (lower >= a) & (upper <= b)
            stay |= (upper >= max(a, _kth(lower[sure], k))) & (lower <= b)
        return stay
    return keep


def _best(rows, scores, ids, k):
    """The places of the ``k`` best: high scores, then small ids, null ids last."""
    return np.lexsort((ids[rows], -scores))[:k]


class _Block:
    """Rows of a cell that came together, by dimension."""

    def __init__(self, batch: pa.RecordBatch, take: np.ndarray):
        part = batch.take(pa.array(take))
        q = part.column("q")
        dims = len(q[0]) if len(q) else 0
        values = q.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        self.by_dim = np.ascontiguousarray(values.reshape(len(q), dims).T)
        self.low = self.by_dim.min(axis=1) if len(q) else np.zeros(0, np.int64)
        self.high = self.by_dim.max(axis=1) if len(q) else np.zeros(0, np.int64)
        self.row = part.column("row").to_numpy()
        self.ids = part.column("id").fill_null(int(NONE)).to_numpy(zero_copy_only=False)
        self.known = part.column("id").is_valid().to_numpy(zero_copy_only=False)
        self.label = part.column("label").to_numpy(zero_copy_only=False)


def _found(block: _Block, anchor: dict, k: int, low: int, high: int):
    """(window score or None, place, score) of the best of one block."""
    other = block.label != anchor["label"]
    if anchor["scores"] is None:
        alive = ~other & (block.row != anchor["row"])
        rows, scores = scan(anchor["q"], block.by_dim, block.low, block.high, alive, nearest(k))
        return [(None, int(rows[i]), int(scores[i])) for i in _best(rows, scores, block.ids, k)]
    windows = [(-(-low * s // 100), high * s // 100) for s in anchor["scores"]]
    rows, scores = scan(anchor["q"], block.by_dim, block.low, block.high, other, in_windows(windows, k))
    out = []
    for s, (a, b) in zip(anchor["scores"], windows):
        own = np.flatnonzero((scores >= a) & (scores <= b))
        out += [(s, int(rows[own[i]]), int(scores[own[i]])) for i in _best(rows[own], scores[own], block.ids, k)]
    return out


def _cells(k: int, low: int, high: int):
    """The scan as a function of Arrow batches sorted by cell, anchors first."""
    def batches(it):
        cell, anchors = None, {}
        for b in it:
            of = np.stack([b.column(c).to_numpy() for c in ("block", "chunk", "kind")])
            sizes = pc.list_value_length(b.column("q")).to_numpy()
            cuts = np.flatnonzero((np.diff(of, axis=1) != 0).any(axis=0)) + 1
            out = {"anchor_row": [], "window": [], "id": [], "score": []}
            for start, end in zip([0, *cuts], [*cuts, b.num_rows]):
                block, chunk, kind = of[:, start]
                if cell != (block, chunk):
                    cell, anchors = (block, chunk), {}
                if kind == 0:  # the anchors of the cell, by their number of dimensions
                    for r in b.slice(start, end - start).to_pylist():
                        r["q"] = np.array(r["q"], np.int64)
                        anchors.setdefault(len(r["q"]), []).append(r)
                    continue
                for dims in np.unique(sizes[start:end]):
                    if not anchors.get(int(dims)):
                        continue
                    rows = _Block(b, start + np.flatnonzero(sizes[start:end] == dims))
                    for anchor in anchors[int(dims)]:
                        for window, place, score in _found(rows, anchor, k, low, high):
                            out["anchor_row"].append(anchor["row"])
                            out["window"].append(window)
                            out["id"].append(int(rows.ids[place]) if rows.known[place] else None)
                            out["score"].append(score)
            yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in out.items()})
    return batches


def _scan_all(rows: DataFrame, anchors: DataFrame, blocks: int, chunks: int, k: int,
              low: int = 0, high: int = 0) -> DataFrame:
    """``anchor_row, window, id, score``: the best ``k`` of each block."""
    dealt = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    dealt_anchor = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(chunks)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    mine = rows.select(dealt.alias("block"), every(chunks).alias("chunk"), F.lit(1).alias("kind"), "row", "id", "label",
                       "q", F.lit(None).cast("array<bigint>").alias("scores"))
    asked = anchors.select(every(blocks).alias("block"), dealt_anchor.alias("chunk"), F.lit(0).alias("kind"), "row",
                           "id", "label", "q", "scores")
    cells = mine.unionByName(asked).repartition("block", "chunk").sortWithinPartitions("block", "chunk", "kind")
    return cells.mapInArrow(_cells(k, low, high), "anchor_row bigint, window bigint, id bigint, score bigint")


def _first(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The ``k`` best per key with their ``rank``; Spark limits each group before the shuffle."""
    order = W.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
         rows_a_block: int = ROWS, anchors_a_chunk: int = ANCHORS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows``: ``id, label, q`` as from ``scaled``; scores are inner products of
    ``q``, high scores come first, and ties are broken by the smaller id (null
    ids last, never anchors). An anchor's positives are its first other rows of
    the same label; for each, the first rows of other labels whose score lies
    between ``low`` and ``high`` percent of the positive's are returned, ``rank``
    counting from 1. Both lists are shorter where there are fewer rows. Rows
    meet only rows with as many components. Repeated rows are rows of their
    own: a copy of an anchor may be its positive, and a copied anchor returns
    its rows again. Empty tables give no rows.
    """
    shared = Shared(rows.sparkSession, "negatives")
    rows = shared.table(rows.select("id", "label", "q").withColumn("row", F.monotonically_increasing_id()), "rows")
    asked = shared.table(rows.filter(is_anchor), "anchors")
    n, n_asked = rows.count(), asked.count()
    blocks, chunks = max(1, math.ceil(n / rows_a_block)), max(1, math.ceil(n_asked / anchors_a_chunk))
    bare = asked.withColumn("scores", F.lit(None).cast("array<bigint>"))
    best = _first(_scan_all(rows, bare, blocks, chunks, positives), ["anchor_row"], positives)
    best = shared.table(best.select("anchor_row", F.col("id").alias("positive_id"),
                                    F.col("score").alias("positive_score")), "positives")
    # at most ``positives`` scores an anchor
    scores = best.groupBy(F.col("anchor_row").alias("row")).agg(F.collect_set("positive_score").alias("scores"))
    found = _scan_all(rows, asked.join(scores, "row"), blocks, chunks, negatives, low, high)
    found = _first(found, ["anchor_row", "window"], negatives).select(
        "anchor_row", F.col("window").alias("positive_score"), "rank", F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score"))
    names = asked.select(F.col("row").alias("anchor_row"), F.col("id").alias("anchor_id"))
    return best.join(found, ["anchor_row", "positive_score"]).join(names, "anchor_row").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
