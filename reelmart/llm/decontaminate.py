"""Benchmark decontamination: a hash set of item windows, scanned and verified.

Texts are lower-cased in A-Z and cut into words (digits, letters and all
characters beyond ASCII). A window is ``length`` consecutive words of an item;
a shorter item is one window of all its words. The distinct windows of the
benchmark, hashed, are broadcast while they stay below ``SMALL`` bytes, and
joined by a shuffle beyond that. Documents are scanned once: each position
gives the hash of the window that begins there (a hash of word hashes, so no
window text is built), and only hits leave the scan. Hits are verified against
the words themselves, in the documents that have any; their keys are broadcast
below the same size, so that no other text is shuffled.

Only functions of DataFrames are used. A document's positions are exploded and
looked up without a shuffle; what is shuffled by document are its hits and one
row with its number of words.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart.llm._common import SMALL, Shared, if_small, row_key, text_of

#: A word, after lower-casing: no ASCII but digits and lower-case letters.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same before lower-casing, and what lies between words.
ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: What a broadcast row key takes.
KEY_BYTES = 48


def words_of(text: Column) -> Column:
    """The words of a text, lower-cased in A-Z only; [] if none."""
    low = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def _with(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once and not where it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _window_hashes(hashes: Column, n: int) -> Column:
    """The hashes of all runs of ``n`` words; [] if there are fewer words."""
    each = F.transform(F.sequence(F.lit(0), F.size(hashes) - n), lambda i: F.xxhash64(F.slice(hashes, i + 1, F.lit(n))))
    return F.when(F.size(hashes) >= n, each).otherwise(F.array().cast("array<bigint>"))


def windows_of(bench: DataFrame, id_col: str = "item_id", text_col: str = "text", length: int = 10) -> DataFrame:
    """``item, n, window, h`` per window of each item: its words, text and hash.

    ``item`` is the id as a string, a null id the empty string. Items without a
    word have no window.
    """
    words = bench.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                         words_of(text_of(text_col)).alias("words")).filter(F.size("words") > 0)
    n = F.least(F.size("words"), F.lit(length))
    starts = words.select("item", "words", n.alias("n"),
                          F.explode(F.sequence(F.lit(0), F.size("words") - n)).alias("start"))
    cut = starts.select("item", "n", F.slice("words", F.col("start") + 1, F.col("n")).alias("cut"))
    return cut.select("item", "n", F.array_join("cut", " ").alias("window"),
                      F.xxhash64(_hashes(F.col("cut"))).alias("h"))


def _positions(docs: DataFrame, lengths: list[int], id_col: str, text_col: str) -> DataFrame:
    """``key, id, n, pos, h``: a row per window of each length, and one of n = 0
    per document, whose ``h`` is its number of words."""
    text = text_of(text_col)

    def lists(hashes):
        of = [F.struct(F.lit(0).alias("n"), F.array(F.size(hashes).cast("bigint")).alias("hs"))]
        for n in lengths:
            of.append(F.struct(F.lit(n).alias("n"), _window_hashes(hashes, n).alias("hs")))
        return F.array(*of)

    rows = docs.select(row_key(id_col, text).alias("key"), F.col(id_col).alias("id"),
                       F.explode(_with(_hashes(words_of(text)), lists)).alias("own"))
    return rows.select("key", "id", F.col("own.n").alias("n"), F.posexplode("own.hs").alias("pos", "h"))


def _look_up(positions: DataFrame, grams: DataFrame, small: bool) -> DataFrame:
    """The positions whose hash is a window's, and the rows of n = 0."""
    grams = grams.select(F.col("h").alias("gram_h"), "gram", "window")
    if small:
        on = (F.col("h") == F.col("gram_h")) & (F.col("n") > 0)
        found = positions.join(F.broadcast(grams), on, "left").filter("n = 0 OR gram IS NOT NULL")
    else:
        hits = positions.filter("n > 0").join(grams, F.col("h") == F.col("gram_h"))
        found = hits.unionByName(positions.filter("n = 0"), allowMissingColumns=True)
    return found.drop("gram_h")


def find(docs: DataFrame, bench: DataFrame, length: int = 10, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", small: int = SMALL) -> DataFrame:
    """``key, id, n_words, n_hit, spans, items``, one row per row of ``docs``.

    A word inside any occurrence of a window is hit. ``spans`` are the maximal
    runs of hit words (``start``, ``end`` by word, end exclusive) and ``items``
    the sorted ids, as strings, of the items with an occurring window; both are
    empty arrays where nothing occurs. ``key`` is the row key of id and text;
    rows equal in both share it and each give a row. Null and empty texts have
    no words. Items that repeat an id are one item, those with a null id go by
    the empty string. Empty tables give no rows, or no hits.
    """
    shared = Shared(docs.sparkSession, "windows")
    occurring = shared.table(windows_of(bench, item_col, item_text_col, length), "occurring")
    grams = shared.table(occurring.groupBy("window", "n", "h").agg(F.count(F.lit(1)).alias("seen"))
                         .withColumn("gram", F.monotonically_increasing_id()), "grams")
    facts = grams.agg(F.coalesce(F.sum(F.octet_length("window") + 40), F.lit(0)).alias("size"),
                      F.sort_array(F.collect_set("n")).alias("lengths")).first()
    scanned = shared.table(_look_up(_positions(docs, facts["lengths"], id_col, text_col),
                                    grams, facts["size"] <= small), "scanned")
    # verified against the words themselves
    hit = F.struct("pos", "n", "gram", "window")
    hits = shared.table(scanned.filter("n > 0").groupBy("key").agg(F.collect_set(hit).alias("hits")), "hits")
    text = text_of(text_col)
    met = docs.select(row_key(id_col, text).alias("key"), text.alias("text"))
    # only texts with hits are shuffled
    met = met.join(if_small(hits.select("key"), KEY_BYTES, small), "key", "left_semi").join(hits, "key")

    def verified(words):
        return F.filter("hits", lambda x: F.array_join(F.slice(words, x["pos"] + 1, x["n"]), " ") == x["window"])

    met = shared.table(met.select("key", _with(words_of(F.col("text")), verified).alias("hits"))
                       .dropDuplicates(["key"]), "met")
    places = F.array_sort(F.array_distinct(F.flatten(F.transform(
        "hits", lambda x: F.sequence(x["pos"], x["pos"] + x["n"] - 1)))))
    covered = met.select("key", places.alias("at"))

    def runs(at):
        first = F.filter(at, lambda p, i: (i == 0) | (F.get(at, i - 1) < p - 1))
        last = F.filter(at, lambda p, i: (i == F.size(at) - 1) | (F.get(at, i + 1) > p + 1))
        return F.zip_with(first, last, lambda a, b: F.struct(a.alias("start"), (b + 1).alias("end")))

    covered = covered.select("key", F.size("at").cast("bigint").alias("n_hit"), _with(F.col("at"), runs).alias("spans"))
    items = occurring.select("item", "window").join(grams.select("window", "gram"), "window").select("gram", "item").distinct()
    items = F.broadcast(items) if facts["size"] <= small else items
    named = (met.select("key", F.explode(F.array_distinct(F.transform("hits", lambda x: x["gram"]))).alias("gram"))
             .join(items, "gram").groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("items")))
    return (scanned.filter("n = 0").select("key", "id", F.col("h").alias("n_words"))
            .join(covered, "key", "left").join(named, "key", "left")
            .select("key", "id", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
                    F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def _kept_text(text: Column, spans: Column) -> Column:
    """The text without the words of the spans and what lies between them."""
    def glued(own):
        words, gaps, spans = own["words"], own["gaps"], own["spans"]
        # gap, word, gap, word, ..., gap: word i is at 2i + 1
        parts = F.concat(F.flatten(F.zip_with(F.slice(gaps, 1, F.size(words)), words, lambda g, w: F.array(g, w))),
                         F.slice(gaps, -1, 1))
        begins = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: 2 * s["end"]))
        ends = F.concat(F.transform(spans, lambda s: 2 * s["start"] + 1), F.array(2 * F.size(words) + 1))
        keep = F.zip_with(begins, ends, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        return _with(parts, lambda p: F.array_join(F.flatten(F.transform(
            keep, lambda k: F.slice(p, k["a"] + 1, k["b"] - k["a"]))), ""))

    # a zero byte at either end, so that there is a gap before and after each word
    closed = F.concat(F.lit("\x00"), text, F.lit("\x00"))
    left = _with(F.struct(F.regexp_extract_all(closed, F.lit(ANY_CASE), F.lit(0)).alias("words"),
                          F.regexp_extract_all(closed, F.lit(BETWEEN), F.lit(0)).alias("gaps"),
                          spans.alias("spans")), glued)
    return _with(left, lambda t: F.substring(t, F.lit(2), F.length(t) - 2))


def clean(docs: DataFrame, found: DataFrame, whole: bool = False, least: int = 1, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``docs`` without what ``find`` found in them.

    ``whole``: documents with ``least`` or more hit words go. Otherwise their
    hit words go, with what lies between two hit words of a span; a document
    whose words are all hit is dropped, and ``n_chars`` follows the new text.
    Documents without hits stay as they are, null texts included.
    """
    text = text_of(text_col)
    marks = (found.filter(F.col("n_hit") >= (least if whole else 1)).dropDuplicates(["key"])
             .select(F.col("key").alias("hit_key"), "n_words", "n_hit", "spans"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), row_key(id_col, text).alias("row_key"))
    rows = rows.join(marks, F.col("row_key") == F.col("hit_key"), "left_anti" if whole else "left")
    if whole:
        return rows.select("row.*")
    rows = rows.filter("hit_key IS NULL OR n_hit < n_words").select(
        "row", "hit_key", F.when(F.col("hit_key").isNotNull(),
                                 _kept_text(F.col("row")[text_col], F.col("spans"))).alias("left"))
    out = []
    for f in docs.schema.fields:
        c = F.col("row")[f.name]
        if f.name == text_col:
            c = F.when(F.col("hit_key").isNull(), c).otherwise(F.col("left"))
        elif f.name == "n_chars":
            c = F.when(F.col("hit_key").isNull(), c).otherwise(F.length("left")).cast(f.dataType)
        out.append(c.alias(f.name))
    return rows.select(*out)
