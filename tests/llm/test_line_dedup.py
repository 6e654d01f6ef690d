import random

import numpy as np
import pytest
import xxhash
from conftest import documents
from hypothesis import given, settings
from hypothesis import strategies as st

from reelmart.llm import line_dedup as d


def slow_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(new[-1] + 1, row[j + 1] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text("abc 😀", max_size=30), st.text("abc 😀", max_size=30))
def test_edit_distance(a, b):
    assert d.edit_distance(a, b) == slow_distance(a, b)
    longer = max(len(a), len(b))
    want = longer == 0 or slow_distance(a, b) <= int(longer * 0.2 + 1e-9)
    assert d.similar(a, b, 0.8) == want


def test_normalise():
    assert d.normalise("  Héllo, WORLD 2024!\t(x) ") == "héllo world 0000 x"
    assert d.normalise("--- ... !!!") == "" and d.normalise("a\x0bb") == "a b"


def slow_simhash(hasher, line):
    sums, total = np.zeros(64, int), 0
    for w in line.split(b" "):
        h, size = hasher.words(w)
        weight = min(int(size[0]), 12)
        sums += np.unpackbits(h.view(np.uint8), bitorder="little").astype(int) * weight
        total += weight
    return int(np.packbits(sums * 2 > total, bitorder="little").view(np.uint64)[0])


def test_simhash_of_short_and_very_long_lines():
    rnd = random.Random(2)
    lines = [b" ".join(b"".join(rnd.choice([b"a", b"b", "é".encode(), b"0"]) for _ in range(rnd.randint(1, 15)))
                       for _ in range(n)) for n in (1, 2, 40, 399, 400, 401, 1203, 20_000, 3)]
    hasher = d.LineHasher()
    assert hasher.read(lines)[0].tolist() == [slow_simhash(d.LineHasher(), x) for x in lines]
    assert hasher.read([])[0].tolist() == [] and hasher.read([])[1] == []


def slow_blocks(hasher, line):
    """The smallest hashes of runs, each run hashed alone; and a short line's own."""
    w, out = line.split(b" "), set()
    if len(w) >= d.RUN + 3:
        runs = []
        for i in range(len(w) - d.RUN + 1):
            x = sum(int(hasher.words(y)[0][0]) * pow(d.LineHasher.BASE, j, 2 ** 64) for j, y in enumerate(w[i:i + d.RUN]))
            x = ((x := x % 2 ** 64) ^ (x >> 29)) * 0xBF58476D1CE4E5B9 % 2 ** 64
            runs.append(x ^ (x >> 32))
        out = {d._signed(x) for x in sorted(set(runs))[:d.BLOCKS]}
    return out | (d.short_blocks(line) if len(w) <= d.SHORT else set())


def test_blocks():
    rnd = random.Random(5)
    words = [b"".join(rnd.choice([b"a", b"b", "é".encode()]) for _ in range(rnd.randint(1, 6))) for _ in range(300)]
    lines = [b" ".join(rnd.choice(words) for _ in range(n)) for n in (1, 2, 3, 4, 6, 7, 8, 9, 10, 30, 35, 36, 37, 60, 500, 3000)]
    lines += [b"a " * 500 + b"b", b"a b c d " * 90 + b"x y", b"a", b" ".join([b"q"] * 40)]
    got = d.LineHasher().read(lines)[1]
    assert [set(x) for x in got] == [slow_blocks(d.LineHasher(), x) for x in lines]
    assert d.short_blocks(b"one two") == {d._signed(xxhash.xxh3_64_intdigest(x)) for x in (
        b"one two", b"one", b"two", b"<one ", b"> two", b"<one ")} | d.short_blocks(b"one two")


def met(texts, counts, least=0.8):
    """Pairs of ``texts`` that the search compares, by the docstring of line_classes."""
    hasher, raw = d.LineHasher(), [t.encode("utf-8", "surrogatepass") for t in texts]
    fp, of = [slow_simhash(hasher, x) for x in raw], {}
    for i, x in enumerate(hasher.read(raw)[1]):
        for block in x:
            of.setdefault(block, []).append(i)
    rank = [((256 - min(n, 255)) << 54) | (xxhash.xxh64_intdigest(xxhash.xxh3_128_digest(x), seed=42) >> 10)
            for x, n in zip(raw, counts)]
    pairs = set()
    for own in of.values():
        if len(own) < 2:
            continue
        pairs |= {(min(x, y), max(x, y)) for k, x in enumerate(own) for y in own[:k]
                  if len(own) <= d.CROWD or bin(fp[x] ^ fp[y]).count("1") < 64 // int(np.ceil(np.log2(len(own) / 32)))}
        hub = min(own, key=rank.__getitem__)
        pairs |= {(min(x, hub), max(x, hub)) for x in own if x != hub}
    return {(x, y) for x, y in pairs if bin(fp[x] ^ fp[y]).count("1") <= d.DISTANCE
            and abs(len(texts[x]) - len(texts[y])) <= max(len(texts[x]), len(texts[y])) * (1 - least) + 1e-9}


def brute(rows, d_key, least=0.8):
    """(id, key, pos) -> (first id, first pos, kept); rows of (id, text)."""
    lines, n_of = [], {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if n := d.normalise(line):
                n_of[n] = n_of.get(n, 0) + 1
    for i, t in {(i, t or "") for i, t in rows}:
        for p, line in enumerate(t.split("\n")):
            if n := d.normalise(line):
                lines.append((i, t, p, n))
    texts = sorted(n_of)
    root = {t: t for t in texts}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    for x, y in met(texts, [n_of[t] for t in texts], least):
        if find(texts[x]) != find(texts[y]) and d.similar(texts[x], texts[y], least):
            root[find(texts[x])] = find(texts[y])
    best = {}
    order = lambda i, t, p: (i is None, i or 0, d_key(i, t), p)
    for i, t, p, n in lines:
        r = find(n)
        best[r] = min(best.get(r, order(i, t, p)), order(i, t, p))
    out = {}
    for i, t, p, n in lines:
        b = best[find(n)]
        out[str(i), d_key(i, t), p] = (str(None if b[0] else b[1]), b[3], b == order(i, t, p))
    return out


def keys(docs):
    """(id, text) -> the key that stands for such a row."""
    text = d.text_of("text")
    rows = docs.select("doc_id", text.alias("t"), d.row_key("doc_id", text).alias("k")).collect()
    known = {(r.doc_id, r.t): bytes(r.k) for r in rows}
    assert len(set(known.values())) == len(known)
    return lambda i, t: known[i, t]


def check(docs, rows):
    got = {(str(r.id), bytes(r.key), r.pos): (str(r.first_id), r.first_pos, r.kept)
           for r in d.line_classes(docs).collect()}
    assert got == brute(rows, keys(docs))
    return got


def test_planted_variants(spark):
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9))) for _ in range(400)]
    base = [" ".join(rnd.choices(words, k=40)) for _ in range(12)]
    rows = []
    for i in range(150):
        lines = []
        for line in rnd.sample(base, 3):
            w = line.split()
            for _ in range(rnd.randint(0, 3)):
                w[rnd.randrange(len(w))] = rnd.choice(words)
            lines.append(" ".join(w).capitalize() + rnd.choice([".", "!", "  "]))
        rows.append((i, "\n".join([*lines, f"own line {rnd.choice(words)} {i}"])))
    got = check(spark.createDataFrame(rows, "doc_id long, text string"), rows)
    assert sum(not k for *_, k in got.values()) > 200


def test_edge_rows(edge_docs, edge_rows):
    got = check(edge_docs, [(r[0], r[1]) for r in edge_rows])
    assert got


def test_whole_table(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    check(docs, [(r.doc_id, r.text) for r in docs.collect()])


def test_dropping_lines(spark, edge_docs):
    rows = [(2, "Keep me here now\nShared line of words, one", 9), (1, "shared line of words one", 24),
            (3, "---\nshared LINE of words: one", 9), (4, None, 0), (5, "", 0), (6, "x y\nz\nX Y!", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").selectExpr("*", "'x' AS `left`", "1 AS row")
    out = {r.doc_id: (r.text, r.n_chars) for r in d.drop_duplicate_lines(df).collect()}
    assert out == {1: ("shared line of words one", 24), 2: ("Keep me here now", 16), 4: (None, 0), 5: ("", 0),
                   6: ("x y\nz", 5)}
    assert d.drop_duplicate_lines(edge_docs).columns == edge_docs.columns


def test_empty_table(no_docs):
    assert d.line_classes(no_docs).count() == 0 and d.drop_duplicate_lines(no_docs).count() == 0


def test_node_hash_is_of_the_normalised_line(spark):
    r = d.lines_of(spark.createDataFrame([(1, "A,  b")], "doc_id long, text string")).first()
    assert bytes(r.node) == xxhash.xxh3_128_digest(b"a b")


def linked_share(texts, pairs, got):
    """Share of the pairs whose lines are in one class; got: line -> class."""
    return sum(got[texts[x]] == got[texts[y]] for x, y in pairs) / len(pairs)


def test_recall_against_plain_edit_similarity(spark):
    """All pairs of the table's lines with edit similarity >= 0.8, whatever their blocks and prints."""
    docs = documents(spark, "/root/testdata/sf0.001")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    texts = sorted({n for _, t in rows for line in (t or "").split("\n") if (n := d.normalise(line))}, key=len)
    letters = np.array([[t.count(c) for c in "abcdefghijklmnopqrstuvwxyz éü0"] for t in texts])
    pairs = []
    for i, t in enumerate(texts):
        last = int(np.searchsorted([len(x) for x in texts], len(t) / 0.8 + 1e-9, "right"))
        diff = letters[i + 1:last] - letters[i]
        # each edit adds a letter at most and takes one at most
        near = np.maximum(np.maximum(diff, 0).sum(1), np.maximum(-diff, 0).sum(1)) <= 0.25 * len(t) + 1
        pairs += [(i, i + 1 + int(j)) for j in np.flatnonzero(near) if d.similar(t, texts[i + 1 + int(j)], 0.8)]
    assert len(pairs) > 30
    of, text = {}, dict(rows)
    for r in d.line_classes(docs).collect():
        of[d.normalise(text[r.id].split("\n")[r.pos])] = (r.first_id, r.first_pos)
    assert linked_share(texts, pairs, of) >= 0.95


def test_crowded_blocks(spark):
    """A passage within many unlike lines, many copies of one line, and both in one block."""
    rnd = random.Random(11)
    words = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 9))) for _ in range(900)]
    passage, base = " ".join(rnd.choices(words, k=30)), rnd.choices(words, k=40)
    lines = [" ".join([*rnd.choices(words, k=20), passage, *rnd.choices(words, k=20)]) for _ in range(150)]
    for i in range(200):
        w = list(base)
        for _ in range(rnd.randint(1, 9)):
            w[rnd.randrange(len(w))] = rnd.choice(words)
        lines.append(" ".join(w))
    lines += [f"{x} {passage}" for x in words[:40]] + [passage] * 3
    rnd.shuffle(lines)
    rows = list(enumerate(lines))
    got = check(spark.createDataFrame(rows, "doc_id long, text string"), rows)
    assert sum(not k for *_, k in got.values()) > 200


def test_links_do_not_depend_on_the_lines_that_share_a_block(spark):
    """Two lines 10 to 16 bits apart, alike only in a passage, alone and among many lines that hold it."""
    rnd, hasher = random.Random(5), d.LineHasher()
    word = lambda letters, n: "".join(rnd.choice(letters) for _ in range(n))
    passage = " ".join(word("abcdefghij", 7) for _ in range(24))
    while True:
        x, y = (passage + " " + " ".join(word(letters, 5) for _ in range(6)) for letters in ("klmnop", "qrstuv"))
        bits = bin(slow_simhash(hasher, x.encode()) ^ slow_simhash(hasher, y.encode())).count("1")
        if 10 <= bits <= 16 and d.similar(x, y, 0.8) and met([x, y], [1, 1]):
            break
    others = [passage + " " + " ".join(word("klmnopqrstuv", 12) for _ in range(12)) for _ in range(1500)]
    for more in ([], [*others, *others[:1] * 3]):  # the repeated line is the most frequent one of the block
        rows = list(enumerate([x, y, *more]))
        got = {(r.id): (r.first_id, r.kept) for r in d.line_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got[1] == (0, False) and got[0] == (0, True)


def test_query_and_pipeline_find_similar_lines_far_apart_in_bits(spark, scratch):
    import corpus_pipeline
    from reelmart.llm.queries import op2_fuzzy_lines
    rnd, hasher, rows = random.Random(9), d.LineHasher(), []
    while len(rows) < 40:  # pairs that differ in 9 to 16 bits
        w = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9))) for _ in range(30)]
        swap = set(rnd.sample(range(30), rnd.randint(1, 4)))
        x, y = " ".join(w), " ".join("".join(rnd.choice("klmnop") for _ in v) if i in swap else v for i, v in enumerate(w))
        bits = bin(slow_simhash(hasher, x.encode()) ^ slow_simhash(hasher, y.encode())).count("1")
        if 9 <= bits <= 16 and d.similar(x, y, 0.8) and met([x, y], [1, 1]):
            rows += [(len(rows), x), (len(rows) + 1, y)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{scratch}/documents.parquet")
    got = {r.doc_id: (r.first_doc_id, r.kept) for r in op2_fuzzy_lines(spark, scratch).collect()}
    assert got == {i: (i - i % 2, i % 2 == 0) for i in range(40)}
    left = corpus_pipeline.line_stage(spark, docs, scratch).collect()
    assert sorted(r.doc_id for r in left) == list(range(0, 40, 2))


@settings(max_examples=200, deadline=None)
@given(st.text("ab 😀", max_size=90), st.lists(st.text("ab 😀", max_size=90), min_size=1, max_size=6))
def test_one_line_against_many(a, others):
    others = [*others, a, a[:-3] + "b", a[2:] + a[:2], "b" + a]
    budgets = [int(max(len(a), len(b)) * 0.2 + 1e-9) for b in others]
    assert d.within(a, others, budgets) == [slow_distance(a, b) <= k for b, k in zip(others, budgets)]


def test_near_lines_of_a_block_do_not_become_pairs(spark, monkeypatch):
    """200 lines around one passage: within 16 bits of each other, shared blocks, none similar."""
    rnd, hasher = random.Random(3), d.LineHasher()
    word = lambda letters, n: "".join(rnd.choice(letters) for _ in range(n))
    passage = " ".join(word("abcdefghij", 11) for _ in range(22))
    lines = []
    while len(lines) < 200:
        x = passage + " " + " ".join(word("klmnopqrstuv", 4) for _ in range(30))
        lines.append(x)
    pairs = met(lines, [1] * 200)
    assert len(pairs) > 10_000 and not any(d.similar(lines[x], lines[y], 0.8) for x, y in list(pairs)[:500])
    stored, write = [], d.Shared.table

    def table(self, df, name, observe=None):
        out = write(self, df, name, observe)
        stored.append((name, out.count()))
        return out
    monkeypatch.setattr(d.Shared, "table", table)
    rows = list(enumerate(lines))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = d.line_classes(docs).collect()
    assert len(got) == 200 and all(r.kept for r in got)
    assert max(n for _, n in stored) <= 200 * 10, stored


def test_parts_of_a_block(spark, monkeypatch):
    """Blocks dealt into many parts give the classes of blocks that are compared whole."""
    monkeypatch.setattr(d, "CELL", 7)
    monkeypatch.setattr(d, "PART", 16)
    test_crowded_blocks(spark)
