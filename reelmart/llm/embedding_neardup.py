"""Embedding near-duplicates by randomised-rotation binary codes.

Each distinct vector is rotated at random and kept as its sign code with a
correction factor (the code's inner product with the rotated vector). For a
pair, the code of one and the rotated other give an unbiased estimate of their
cosine with a confidence bound; only pairs whose upper bound reaches the
threshold are recomputed exactly in double precision, and only exact values
link.

Pairs meet in bands of random hyperplane bits. The band width follows the
logarithm of the number of vectors, so chance meetings per vector stay the
same at any size, and the number of bands is set so that a pair exactly at the
threshold is missed with probability ``MISS`` at most (closer pairs less).
Vectors travel only for bands in which at least two of them meet. A large band
bucket is split into blocks, and each pair of blocks is a group of its own, so
no task holds more than two blocks; a pair counts only in its first common
band. Groups give counts and one link per vector, never their pairs.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmart.llm._common import Shared
from reelmart.llm.components import components

#: Chance to miss a pair exactly at the threshold: by the bands, and by the
#: confidence bound of the code estimate (2 exp(-EPSILON^2 / 2)).
MISS, EPSILON = 1e-4, 5.0
BLOCK = 512
#: Vectors are scaled to integers for the bands, so that every machine finds
#: the same bits whatever the order of its sums.
SCALE = 1 << 20


def band_shape(n: int, threshold: float) -> tuple[int, int]:
    """(bits per band, bands) for ``n`` distinct vectors."""
    bits = min(40, max(16, math.ceil(math.log2(max(n, 2))) + 4))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log(1 - same))


@lru_cache(maxsize=8)
def hyperplanes(dim: int, count: int) -> np.ndarray:
    return np.rint(np.random.default_rng(17).standard_normal((dim, count)) * 256)


@lru_cache(maxsize=8)
def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(23).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def band_bits(u: np.ndarray, bits: int, bands: int) -> np.ndarray:
    """The bits of each band as integers, one row per unit vector."""
    out = np.empty((len(u), bands), np.int64)
    powers = 1 << np.arange(bits, dtype=np.int64)
    planes, scaled = hyperplanes(u.shape[1], bits * bands), np.rint(u * SCALE)
    for b in range(0, len(u), 2048):
        signs = (scaled[b:b + 2048] @ planes > 0).reshape(-1, bands, bits)
        out[b:b + 2048] = (signs * powers).sum(axis=2)
    return out


def encode(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign codes of the rotated vectors, and their correction factors."""
    r = u @ rotation(u.shape[1])
    return np.packbits(r > 0, axis=1), np.abs(r).sum(axis=1) / math.sqrt(u.shape[1])


def _array(col) -> np.ndarray:
    return np.asarray(col.values.to_numpy(zero_copy_only=False), np.float64)


def _by_dim(lengths: np.ndarray):
    for dim in np.unique(lengths):
        yield int(dim), np.flatnonzero(lengths == dim)


def _matrix(col, rows: np.ndarray, dim: int) -> np.ndarray:
    offsets = col.offsets.to_numpy()
    flat = _array(col)
    return flat[offsets[rows][:, None] - offsets[0] + np.arange(dim)] if len(rows) else np.zeros((0, dim))


def _pair_index(sizes: np.ndarray, starts: np.ndarray, most: int):
    """Arrays of index pairs within groups, about ``most`` pairs at a time."""
    for s in np.unique(sizes[sizes > 1]):
        i, j = np.triu_indices(s, 1)
        at = starts[sizes == s]
        step = max(1, most // len(i))
        for k in range(0, len(at), step):
            base = at[k:k + step, None]
            a, b = (base + i).ravel(), (base + j).ravel()
            for c in range(0, len(a), most):
                yield a[c:c + most], b[c:c + most]


def _group_links(group, block_pair, block, node, copies, u, code, factor, band, threshold, shape):
    """Links among the members of each group: per member ``node, links, root``.

    All arrays are per member row, groups contiguous. ``links`` adds the copies
    of partners whose first common band is this one; ``root`` is the smallest
    member reachable within the group.
    """
    n, dim = u.shape
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.concatenate((starts, [n])))
    turned = u @ rotation(dim)
    signs = (np.unpackbits(code, axis=1, count=dim).astype(np.float64) * 2 - 1) / math.sqrt(dim)
    slack = np.sqrt(np.maximum(1 - factor ** 2, 0)) / factor * EPSILON / math.sqrt(max(dim - 1, 1))
    found_a, found_b = [], []
    for a, b in _pair_index(sizes, starts, 1 << 16):
        apart = block_pair[a] & (block[a] == block[b])  # met in a group of one block
        a, b = a[~apart], b[~apart]
        estimate = np.einsum("ij,ij->i", signs[a], turned[b]) / factor[a]
        near = estimate + slack[a] >= threshold
        a, b = a[near], b[near]
        exact = np.einsum("ij,ij->i", u[a], u[b]) >= threshold
        found_a.append(a[exact])
        found_b.append(b[exact])
    a = np.concatenate(found_a) if found_a else np.zeros(0, np.int64)
    b = np.concatenate(found_b) if found_b else np.zeros(0, np.int64)
    links, root = np.zeros(n, np.int64), np.arange(n)
    if len(a):
        used, where = np.unique(np.concatenate((a, b)), return_inverse=True)
        keys = band_bits(u[used], *shape)
        ia, ib = where[:len(a)], where[len(a):]
        for c in range(0, len(a), 1 << 16):
            s = slice(c, c + (1 << 16))
            first = (keys[ia[s]] == keys[ib[s]]).argmax(axis=1) == band[a[s]]
            np.add.at(links, a[s][first], copies[b[s][first]])
            np.add.at(links, b[s][first], copies[a[s][first]])
        while True:  # the smallest member reachable
            low = np.minimum(root[a], root[b])
            before = root.copy()
            np.minimum.at(root, a, low)
            np.minimum.at(root, b, low)
            root = root[root]
            if (root == before).all():
                break
    hit = np.zeros(n, bool)
    hit[a] = hit[b] = True
    return node[hit], links[hit], node[root[hit]]


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    threshold: float = 0.95) -> DataFrame:
    """``id, n_links, component, kept`` per row of ``vectors``.

    ``n_links`` counts the other rows linked directly (cosine of ``threshold``
    or more, equal vectors included), ``component`` is the smallest id
    reachable over links, the row's own included, and ``kept`` marks the rows
    whose id it is. Null, empty and zero vectors and those with null or
    non-finite entries link with nothing; vectors of different lengths do not
    link. Rows that repeat an id are vectors of their own; rows without an id
    have ids of their links only and are not kept. An empty table gives none.
    """
    shared = Shared(vectors.sparkSession, "vectors")
    kind = vectors.schema[vec_col].dataType.simpleString()
    vec = F.col(vec_col) if kind in ("array<float>", "array<double>") else F.col(vec_col).cast("array<double>")
    kind = kind if kind in ("array<float>", "array<double>") else "array<double>"
    # not null, not NaN and, since NaN ranks above infinity, below it
    whole = F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < F.lit(math.inf)))
    valid = F.col("vec").isNotNull() & F.coalesce(whole, F.lit(False)) & F.exists("vec", lambda x: x != 0)
    rows = vectors.select(F.col(id_col).alias("id"), vec.alias("vec")).select(
        "id", "vec", F.coalesce(valid, F.lit(False)).alias("valid"),
        F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(1), "vec").alias("h2"))
    distinct = (rows.filter("valid").groupBy("h1", "h2")
                .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("vec").alias("vec"))
                .withColumn("node", F.monotonically_increasing_id()))
    distinct = shared.table(distinct, "distinct")  # its node numbers are fixed by writing it
    shape = band_shape(distinct.count(), threshold)

    def encoded(it):
        for b in it:
            lengths = np.diff(b.column(2).offsets.to_numpy())
            for dim, at in _by_dim(lengths):
                u = unit(_matrix(b.column(2), at, dim))
                code, factor = encode(u)
                take = pa.array(at)
                yield pa.RecordBatch.from_arrays([
                    b.column(0).take(take), b.column(1).take(take), b.column(2).take(take),
                    pa.array(np.full(len(at), dim, np.int32)), pa.array([c.tobytes() for c in code], pa.binary()),
                    pa.array(factor), pa.ListArray.from_arrays(
                        pa.array(np.arange(0, len(at) * shape[1] + 1, shape[1]), pa.int32()),
                        pa.array(band_bits(u, *shape).ravel()))],
                    ["node", "copies", "vec", "dim", "code", "factor", "bands"])

    stored = shared.table(distinct.select("node", "copies", "vec").mapInArrow(
        encoded, f"node bigint, copies bigint, vec {kind}, dim int, code binary, factor double, bands array<bigint>"),
        "codes")
    member = stored.select("node", "dim", F.posexplode("bands").alias("band", "bits"))
    key = ["dim", "band", "bits"]
    busy = member.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks.cast("bigint")).cast("int")
    met = (member.join(busy, key).withColumn("block", own)
           .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
           .select(*key, F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                   "block", "node"))
    group = [*key, "lo", "hi"]
    met = (met.join(stored.drop("bands", "dim"), "node").repartition(*group).sortWithinPartitions(*group)
           .select(F.xxhash64(*group).alias("group"), (F.col("lo") != F.col("hi")).alias("pair"),
                   "block", "node", "copies", "vec", "code", "factor", "band"))

    def linked(it):
        rest = None
        def work(t):
            t = t.combine_chunks()
            part = lambda i: t.column(i).chunk(0)
            lengths = np.diff(part(5).offsets.to_numpy())
            num = lambda i: part(i).to_numpy(zero_copy_only=False)
            out = []
            for dim, at in _by_dim(lengths):  # a group has one dim
                code = np.frombuffer(b"".join(part(6).take(pa.array(at)).to_pylist()), np.uint8).reshape(len(at), -1)
                out.append(_group_links(num(0)[at], num(1)[at], num(2)[at], num(3)[at], num(4)[at],
                                        unit(_matrix(part(5), at, dim)), code, num(7)[at], num(8)[at], threshold, shape))
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["node", "links", "root"])
        for b in it:
            now = pa.Table.from_batches([b])
            now = now if rest is None else pa.concat_tables([rest, now])
            ids = now.column(0).to_numpy()
            cut = int(np.flatnonzero(ids != ids[-1])[-1]) + 1 if (ids != ids[-1]).any() else 0
            if cut >= 20_000:  # the last group may go on in the next batch
                yield work(now.slice(0, cut))
                now = now.slice(cut)
            rest = now
        if rest is not None and rest.num_rows:
            yield work(rest)

    found = shared.table(met.mapInArrow(linked, "node bigint, links bigint, root bigint"), "found")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    comp = shared.table(components(found.select(F.col("node").alias("u"), F.col("root").alias("v")), shared), "classes")
    lead = (comp.join(distinct.select("node", "rep"), "node").groupBy("component")
            .agg(F.min("rep").alias("component_rep")))
    per_vector = (distinct.select("h1", "h2", "node", "rep", "copies").join(links, "node", "left")
                  .join(comp, "node", "left").join(lead, "component", "left")
                  .select(F.col("h1").alias("g1"), F.col("h2").alias("g2"),
                          (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                          F.coalesce("component_rep", "rep").alias("component")))
    per_vector = shared.table(per_vector, "result")
    shared.drop(stored, found)
    out = rows.join(per_vector, F.col("valid") & (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")), "left")
    component = F.when(F.col("valid"), F.col("component")).otherwise(F.col("id"))
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      component.alias("component"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
