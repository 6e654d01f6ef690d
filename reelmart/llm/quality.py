"""Ordinal quality classifier: cumulative-link regression on graded ratings.

One weight per hashed text feature is shared by all grades; ordered thresholds
cut the score into grades 0..K-1, so that P(grade <= k) = s(theta_k - score).
That gives an expected grade and the tail probability P(grade >= k) by which
documents are selected.

Features are hashed presences: lower-cased words, their first letters, and the
text's shape (shares of repeated, capital and symbol-bearing words, in steps).
The fit reads a bounded sample of rated documents, ``SAMPLE`` rows chosen by
the hash of their id; scoring covers every document and its whole text.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmart.llm._common import pieces

DIMS = 1 << 18
#: At most so many rated documents are fitted on.
SAMPLE = 20_000
LETTERS = re.compile(r"[^\W\d_]+")
SYMBOL = re.compile(r"[^\w\s.,;:'()-]")


def _step(part: float) -> int:
    """Shares in steps of about one and a half, from 1 % on."""
    return 0 if part < 0.01 else 1 + int(math.log(part / 0.01) / math.log(1.5))


def tokens_of(text: str) -> set[str]:
    """The features of a text, before hashing."""
    words = text.split()
    out = set(LETTERS.findall(text.lower()))
    out |= {f"{w[:5]}~" for w in out if len(w) > 5}
    n = len(words)
    if n:
        again = sum(map(str.__eq__, words, words[1:])) / n
        upper = sum(map(str.isupper, words)) / n
        marks = len(SYMBOL.findall(text)) / n
        out |= {f"again {_step(again)}", f"upper {_step(upper)}", f"marks {_step(min(marks, 2.0))}"}
    else:
        out.add("empty ")
    return out


def hashed(token: str) -> int:
    return zlib.crc32(token.encode("utf-8", "surrogatepass")) % DIMS


@dataclass(frozen=True)
class Model:
    """``weights`` by hashed feature, and the K - 1 rising ``thresholds``."""
    weights: np.ndarray
    thresholds: np.ndarray

    def grades(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1..K-1, one row per score."""
        z = np.clip(scores[:, None] - self.thresholds[None, :], -60, 60)
        return 1 / (1 + np.exp(-z))


def prior_scale(seen: np.ndarray, size: np.ndarray) -> np.ndarray:
    """How far each feature's weight is expected to lie from 0.

    ``seen``: documents by grade and feature, ``size``: documents by grade. The
    largest log odds ratio of the feature over the cuts between grades, less
    1.64 standard errors: words that tell nothing about grades (most) get 0, so
    that the many neutral words of a long text cannot drown a telling one.
    """
    out = np.zeros(seen.shape[1])
    for k in range(1, len(size)):
        low, high = seen[:k].sum(axis=0) + 0.5, seen[k:].sum(axis=0) + 0.5
        n_low, n_high = size[:k].sum() + 1.0, size[k:].sum() + 1.0
        ratio = np.log(low / (n_low - low)) - np.log(high / (n_high - high))
        error = np.sqrt(1 / low + 1 / high + 1 / (n_low - low) + 1 / (n_high - high))
        out = np.maximum(out, np.abs(ratio) - 1.64 * error)
    return out


def _loss(v, cuts, flat, scale, starts, counts, y, l2):
    """Mean negative log likelihood with its gradients; cuts: first, log gaps."""
    w = scale * v
    theta = np.concatenate(([cuts[0]], cuts[0] + np.cumsum(np.exp(cuts[1:]))))
    s = np.add.reduceat(w[flat], starts)
    n, k = len(y), len(theta)
    edge = np.concatenate(([-np.inf], theta, [np.inf]))
    up, low = edge[y + 1] - s, edge[y] - s
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    a, b = np.where(np.isinf(up), 1.0, sig(up)), np.where(np.isinf(low), 0.0, sig(low))
    p = np.maximum(a - b, 1e-12)
    da, db = a * (1 - a) / p, b * (1 - b) / p  # of log p by its upper and lower edge
    g_s = (da - db) / n
    g_v = scale * np.bincount(flat, np.repeat(g_s, counts), minlength=len(w)) + l2 * v
    g_theta = np.zeros(k)
    for j in range(k):
        g_theta[j] = -(da[y == j].sum() - db[y == j + 1].sum()) / n
    g_cuts = np.empty(k)
    g_cuts[0] = g_theta.sum()
    for j in range(1, k):
        g_cuts[j] = g_theta[j:].sum() * np.exp(cuts[j])
    return -np.log(p).mean() + l2 / 2 * (v @ v), np.concatenate((g_v, g_cuts))


def fit_arrays(rows: list[np.ndarray], y: np.ndarray, grades: int, l2: float = 3e-4,
               rounds: int = 120, memory: int = 10) -> Model:
    """Limited-memory quasi-Newton fit; ``rows``: feature indices per document."""
    seen = np.zeros((grades, DIMS))
    for g in range(grades):
        for r in np.flatnonzero(y == g):
            seen[g, rows[r]] += 1
    scale = prior_scale(seen, np.bincount(y, minlength=grades))
    used = np.flatnonzero(scale)
    place = np.zeros(DIMS, np.int32)  # 0: a feature without weight, in every row
    place[used] = np.arange(1, len(used) + 1)
    scale = np.concatenate(([0.0], scale[used]))
    kept = [np.append(np.int32(0), p[p > 0]) for p in (place[r] for r in rows)]
    counts = np.array([len(r) for r in kept])
    flat = np.concatenate(kept)
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    share = np.array([np.mean(y <= k) for k in range(grades - 1)]).clip(0.01, 0.99)
    theta = np.maximum.accumulate(np.log(share / (1 - share)) + 1e-3 * np.arange(grades - 1))
    cuts = np.concatenate(([theta[0]], np.log(np.maximum(np.diff(theta), 1e-2))))
    x, k = np.concatenate((np.zeros(len(scale)), cuts)), grades - 1
    value = lambda x: _loss(x[:-k], x[-k:], flat, scale, starts, counts, y, l2)
    f, g = value(x)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        d, alphas = -g, []
        for s, v in reversed(pairs):
            a = (s @ d) / (s @ v)
            alphas.append(a)
            d = d - a * v
        if pairs:
            s, v = pairs[-1]
            d = d * ((s @ v) / (v @ v))
        for (s, v), a in zip(pairs, reversed(alphas)):
            d = d + s * (a - (v @ d) / (s @ v))
        step, slope = (1.0 if pairs else 1 / max(1.0, np.abs(g).sum())), g @ d
        while step > 1e-10:
            f2, g2 = value(x + step * d)
            if f2 <= f + 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        s, v = step * d, g2 - g
        if s @ v > 1e-12:
            pairs = [*pairs, (s, v)][-memory:]
        done = f - f2 < 1e-8
        x, f, g = x + s, f2, g2
        if done:
            break
    weights = np.zeros(DIMS)
    weights[used] = (scale * x[:-k])[1:]
    cuts = x[-k:]
    return Model(weights, np.concatenate(([cuts[0]], cuts[0] + np.cumsum(np.exp(cuts[1:])))))


def fit(docs: DataFrame, ratings: DataFrame, grades: int, id_col: str = "doc_id",
        text_col: str = "text", grade_col: str = "grade", sample: int = SAMPLE) -> Model | None:
    """Fit on at most ``sample`` rated documents; None where none is rated.

    ``ratings``: id and grade 0..grades-1; null ids or grades are skipped, and
    the lowest of several grades of one id counts. The sample is broadcast to
    the documents (its row bound is ``sample``), and one task fits on it.
    """
    rated = (ratings.select(F.col(id_col).alias("id"), F.col(grade_col).cast("int").alias("grade"))
             .dropna().groupBy("id").agg(F.min("grade").alias("grade"))
             .orderBy(F.xxhash64("id"), "id").limit(sample))

    def indices(it):
        for b in pieces(it):
            rows = [np.unique(np.fromiter(map(hashed, tokens_of(t or "")), np.int32))
                    for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([r.tobytes() for r in rows], pa.binary())], ["grade", "rows"])

    def one(it):
        rows, y = [], []
        for b in it:
            y += b.column(0).to_pylist()
            rows += [np.frombuffer(r, np.int32) for r in b.column(1).to_pylist()]
        if rows:
            m = fit_arrays(rows, np.array(y), grades)
            yield pa.RecordBatch.from_arrays(
                [pa.array([m.weights.tobytes()], pa.binary()), pa.array([m.thresholds.tolist()])],
                ["weights", "thresholds"])

    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    found = (text.join(F.broadcast(rated), "id").select("grade", "text")
             .mapInArrow(indices, "grade int, rows binary")
             .repartition(1).mapInArrow(one, "weights binary, thresholds array<double>").collect())
    if not found:
        return None
    return Model(np.frombuffer(bytes(found[0]["weights"])), np.array(found[0]["thresholds"]))


class Scorer:
    """Scores texts; feature weights are remembered by token, within a bound."""

    REMEMBER = 100_000

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros(len(texts))
        w, known = self.model.weights, self.known
        for i, t in enumerate(texts):
            total = 0.0
            for x in tokens_of(t or ""):
                v = known.get(x)
                if v is None:
                    if len(known) >= self.REMEMBER:
                        known.clear()
                    v = known[x] = float(w[hashed(x)])
                total += v
            out[i] = total
        return out


def score(docs: DataFrame, model: Model | None, grades: int, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``id, expected_grade, tails`` per row; tails: P(grade >= k), k = 1...

    Null and empty texts are scored by their own feature. Without a model every
    document has the best grade. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def batches(it):
        m = shared.value
        scorer = Scorer(m) if m else None
        for b in pieces(it):
            n = b.num_rows
            tails = m.grades(scorer(b.column(1).to_pylist())) if m else np.ones((n, grades - 1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(tails.sum(axis=1)), pa.array(tails.tolist(), pa.list_(pa.float64()))],
                ["id", "expected_grade", "tails"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        batches, f"id {kind}, expected_grade double, tails array<double>")


def select(docs: DataFrame, model: Model | None, grades: int, grade: int, least: float = 0.5,
           text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, with P(grade >= ``grade``) >= ``least``."""
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def batches(it):
        scorer = Scorer(shared.value)
        for b in pieces(it):
            tails = shared.value.grades(scorer(b.column(at).to_pylist()))
            yield b.filter(pa.array(tails[:, grade - 1] >= least))

    return docs.mapInArrow(batches, docs.schema)


def grades_of(labels: DataFrame) -> DataFrame:
    """Ratings from quality and toxicity marks: 0 poor, 1 toxic, 2 good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(
        (F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return labels.select("doc_id", grade.alias("grade"))
