import random
import re

import pytest
from conftest import CLASHES
from pyspark.sql import functions as F

from reelmart.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BIG = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(BIG))


def brute(text, items, length=10):
    """(n_words, hit places, items) of one text."""
    w, hit, found = words(text), set(), set()
    for item, t in items:
        x = words(t)
        n = min(length, len(x))
        for i in range(len(x) - n + 1 if n else 0):
            for p in range(len(w) - n + 1):
                if w[p:p + n] == x[i:i + n]:
                    hit.update(range(p, p + n))
                    found.add("" if item is None else str(item))
    return len(w), hit, sorted(found)


def check(spark, rows, items, length=10, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit(f"extra {c}") for c in [*CLASHES, "item", "gram", "window", "spans", "hits"]})
    bench = spark.createDataFrame(items, "item_id long, text string").withColumns({"item": F.lit(1), "window": F.lit(2)})
    found = d.find(docs, bench, length, **options)
    got = []
    for r in found.collect():
        at = {p for s in r.spans for p in range(s.start, s.end)}
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))
        got.append((r.id, r.n_words, sorted(at), r.n_hit, list(r["items"])))
    want = [(i, n, sorted(h), len(h), f) for i, t in rows for n, h, f in [brute(t, items, length)]]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return docs, found, want


ITEMS = [(1, "The quick brown fox jumps over the lazy dog and then runs far away home"), (2, "Zwölf Boxkämpfer"),
         (2, "the quick brown fox jumps over the lazy dog and then stops"), (None, "Only a null id"), (3, ""), (4, None),
         (5, "?! ..."), (6, "a b a b a b a b a b a b"), (10, "solo")]
LINE = "the QUICK, brown fox: jumps over the lazy dog and"
ROWS = [(1, LINE), (2, "x " + LINE + " then runs y"), (3, None), (4, ""), (5, "  --- "), (None, "Zwölf   boxkämpfer!"),
        (None, "zwölf boxKÄMPFER"), (6, "a b " * 9 + "a"), (7, "one solo two SOLO"), (7, "one solo two SOLO"),
        (8, "only a\x00null. ID 😀 tail"), (9, "the quick brown fox jumps over the lazy dog"), (-1, "fox " * 3000 + LINE)]


@pytest.mark.parametrize("small", [d.SMALL, 0])
def test_edge_rows_and_both_joins(spark, small):
    check(spark, ROWS, ITEMS, small=small)


def test_random_texts(spark):
    rnd = random.Random(3)
    text = lambda n: " ".join(rnd.choice("abc") for _ in range(n))
    rows = [(i, text(rnd.randint(0, 60))) for i in range(120)]
    items = [(i % 9, text(rnd.randint(0, 12))) for i in range(15)]
    _, _, want = check(spark, rows, items, length=6)
    assert any(f for *_, f in want) and any(not f for *_, f in want)


def test_spans_and_documents_are_removed(spark):
    docs, found, want = check(spark, ROWS, ITEMS)
    left = {(r.doc_id, r.text) for r in d.clean(docs, found).collect()}
    assert d.clean(docs, found).columns == docs.columns
    assert left == {(2, "x  y"), (None, "zwölf boxKÄMPFER"), (3, None), (4, ""), (5, "  --- "), (7, "one  two "), (8, " 😀 tail"),
                    (9, ROWS[-2][1]), (-1, "fox " * 3000)} | {(i, t) for i, t in ROWS if i == 6 and not brute(t, ITEMS)[1]}
    assert d.clean(docs, found).filter("doc_id = 7").count() == 2
    kept = sorted(str(r.doc_id) for r in d.clean(docs, found, whole=True).collect())
    assert kept == sorted(str(w[0]) for w in want if not w[3])
    some = sorted(str(r.doc_id) for r in d.clean(docs, found, whole=True, least=3).collect())
    assert some == sorted(str(w[0]) for w in want if w[3] < 3)


def test_length_follows_the_text(spark):
    docs = spark.createDataFrame([(1, "keep solo", 9), (2, "clean", 5)], "doc_id long, text string, n_chars int")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = d.clean(docs, d.find(docs, bench))
    assert {tuple(r) for r in out.collect()} == {(1, "keep ", 5), (2, "clean", 5)} and out.schema == docs.schema


def test_empty_tables(spark, edge_docs, no_docs):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert d.find(no_docs, bench).count() == 0 and d.clean(no_docs, d.find(no_docs, bench)).count() == 0
    found = d.find(edge_docs, bench.limit(0))
    assert found.count() == edge_docs.count() and found.filter("n_hit > 0").count() == 0
    assert d.clean(edge_docs, found).count() == edge_docs.count()


def test_very_long_text(spark, edge_docs, edge_rows):
    items = [(1, "x" * 100_000 + " 1 1 1 1 1 1 1 1 1"), (2, "end end end end end end end end end end")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((str(r.id), r.n_words, r.n_hit, tuple(r["items"])) for r in d.find(edge_docs, bench).collect())
    # the words of the long text: "wörd" x 40,000, the x, "1" x 30,000, "end" x 2,000
    want = [(str(r[0]), len(words(r[1])), *((10 + 2000, ("1", "2")) if r[0] == 5 else (0, ()))) for r in edge_rows]
    assert got == sorted(want)
