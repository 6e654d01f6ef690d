import hashlib
import re

import pytest
from conftest import documents

from reelmart.llm import pii


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


digits = lambda m: re.sub("[^0-9]", "", m.group())
BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.group().split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15)]


def base(text):
    found = [(m.start(), k, f"{n}:{m.start()}:{m.end()}") for k, (n, p, ok) in enumerate(BASE)
             for m in re.finditer(p, text) if ok(m)]
    return [x[2] for x in sorted(found)]


def check(docs, rows):
    got = sorted((str(r.id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans)
                 for r in pii.find(docs).collect())
    want = []
    for i, t in rows:
        b = base(t or "")
        want.append((str(i), *[sum(x.startswith(n + ":") for x in b) for n, *_ in BASE],
                     hashlib.sha256(",".join(b).encode()).hexdigest(), b))
    for g, w in zip(got, sorted(want), strict=True):
        assert g[:6] == w[:6]
        assert set(w[6]) <= set(g[6].split(",")) or not w[6]
    return got


NASTY = [
    "a@b.c a@b.c_d@e.f x.y%z+@-host-.co.uk. @no.com no@ no@host a@b..c a@b.c.@d.e",
    "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 0255.001.1.1 1.2.3 9.9.9.99999999999999999999 1..2.3.4.5 00000001.2.3.4",
    "4041894974608795 4041-8949-7460-8795 4041 8949 7460 8795 5 4041894974608795 4041  894974608795 1234567890123",
    "+1 (555) 123-4567 +44.20.7946.0958 +1 +12 34 +123456789012345678 +1-2-3-4-5-6-7-8-9 ++49 30 1234567 +49 30 12345(",
    "é😀 4111111111111111 😀é me@пример.com me@example.com",
    "(743) 555-3824 and 078-05-1120, DE89370400440532013000, Dr. Anna Smith, jane [at] mail [dot] com",
    "1" * 50_000, "1 " * 50_000, "a." * 50_000 + "@", "a@" + "b." * 50_000 + "c", "+" + "1 " * 50_000, "1.1.1.1." * 20_000,
    "a" * 100_000, "+1" * 40_000, "@" * 50_000, "a-" * 50_000 + "@x.y"]


def test_nasty_texts(spark):
    rows = list(enumerate(NASTY))
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_edge_rows(edge_docs, edge_rows):
    check(edge_docs, [(r[0], r[1]) for r in edge_rows])


def test_whole_table_and_clean_documents(spark):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = check(docs, rows)
    texts = dict(rows)
    for i, *_, spans in got:
        for m in re.finditer(r"(?<!\S)\([0-9]{3}\) [0-9]{3}-[0-9]{4}(?!\S)", texts[int(i)] or ""):
            assert f"local_phone:{m.start()}:{m.end()}" in spans.split(",")
        if not re.search(r"[0-9@]", texts[int(i)] or ""):
            assert spans == ""


def test_no_candidates_and_empty_table(spark, no_docs):
    clean = spark.createDataFrame([(1, "nothing here"), (2, None)], "doc_id long, text string")
    assert [(r.n_email, r.spans) for r in pii.find(clean).collect()] == [(0, ""), (0, "")]
    assert pii.find(no_docs).count() == 0


@pytest.mark.parametrize("kind,text,ok", [
    ("ssn", "078-05-1120", True), ("ssn", "000-12-3456", False), ("ssn", "666-12-3456", False),
    ("iban", "DE89370400440532013000", True), ("iban", "DE89370400440532013001", False),
    ("iban", "GB82WEST12345698765432", True)])
def test_format_checks(spark, kind, text, ok):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(kind, text)], "kind string, match string")
    assert df.select(pii.passes(F.col("match"), F.col("kind"))).first()[0] is ok


def test_reliabilities_are_learned(spark):
    """Votes drawn from labelers of known accuracy; EM ranks them rightly."""
    import random
    rnd = random.Random(8)
    accuracy = dict(zip(pii.LABELERS, (0.95, 0.9, 0.7, 0.6, 0.5)))
    rows, truth = [], []
    for _ in range(3000):
        y = rnd.random() < 0.4
        truth.append(y)
        rows.append(("email", *[(1 if (rnd.random() < a) == y else -1) for a in accuracy.values()], 1))
    df = spark.createDataFrame(rows, "kind string, " + ", ".join(f"{x} int" for x in pii.LABELERS) + ", n long")
    pats = df.groupBy("kind", *pii.LABELERS).agg({"n": "sum"}).withColumnRenamed("sum(n)", "n")
    params, scored = pii.reliabilities(pats)
    power = {x: params[x, 1, "yes"] - params[x, 1, "no"] for x in pii.LABELERS}
    assert power["format"] > power["gazetteer"] > power["context"] > power["edges"] - 0.05
    p = {tuple(r[x] for x in pii.LABELERS): r.p for r in scored.collect()}
    right = sum((p[tuple(r[1:6])] >= 0.5) == y for r, y in zip(rows, truth))
    assert right / len(rows) > 0.93
