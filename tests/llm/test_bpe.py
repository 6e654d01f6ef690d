import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from conftest import documents
from hypothesis import given, settings
from hypothesis import strategies as st

from reelmart.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def slow():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def fast():
    return bpe.load(PATH, P.PATTERN)


def test_byte_table_is_a_bijection():
    t = bpe.byte_table()
    assert sorted(t) == list(range(256)) and len(set(t.values())) == 256
    assert t[ord("A")] == "A" and all(c.isprintable() and not c.isspace() for c in t.values())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text_as_the_reference_library(text):
    e = bpe.load(PATH, P.PATTERN)
    want = tiktoken_encoding().encode_ordinary(text)
    assert e.ids([text])[0] == want
    assert e.decode(want) == text


_cache = {}


def tiktoken_encoding():
    if not _cache:
        _cache["e"] = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})
    return _cache["e"]


def test_every_code_point(slow, fast):
    """Each assigned or unassigned character alone and between letters."""
    texts = ["".join(f"a{chr(c)} {chr(c)}1{chr(c)}{chr(c)}" for c in range(lo, min(lo + 64, 0x110000))
                     if not 0xD800 <= c < 0xE000) for lo in range(0, 0x30000, 64)]
    got = fast.ids(texts)
    bad = [t for t, g in zip(texts, got) if g != slow.encode_ordinary(t)]
    assert not bad, [hex(ord(bad[0][1])), len(bad)]


def test_pattern_splits_every_assigned_character_as_the_tokenizer(fast):
    """Alone, repeated, and next to letters, digits, signs and blanks."""
    import unicodedata
    probe = lambda cs: "".join(f"x{c}9{c} {c}{c}!{c} \n" for c in cs)
    split = lambda t: [t[a:b] for _, (a, b) in fast.tokenizer.pre_tokenizer.pre_tokenize_str(t)]
    for lo in range(0, 0x110000, 4096):
        cs = [chr(c) for c in range(lo, lo + 4096) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
        assert split(probe(cs)) == fast.pattern.findall(probe(cs)), hex(lo)


def test_seen_matches_are_bounded(slow, monkeypatch):
    monkeypatch.setattr(bpe, "SEEN", 100)
    e = bpe.ByteBPE(bpe.read_ranks(PATH), P.PATTERN)
    texts = [f"word{i} {'long' * i}" for i in range(300)]
    for t in texts * 2:
        assert e.ids([t])[0] == slow.encode_ordinary(t)
        assert len(e.seen) < 110 and all(len(w) <= bpe.SEEN_CHARS for w in e.seen)


def test_unknown_id_raises(fast):
    for bad in ([50256], [-1], [1, 10 ** 9]):
        with pytest.raises(KeyError):
            fast.decode_bytes(bad)


def test_special_strings_are_ordinary(slow, fast):
    t = "<|endoftext|> x <s>"
    assert fast.ids([t])[0] == slow.encode_ordinary(t)


def test_split_characters(fast):
    ids = fast.ids(["😀"])[0]
    assert len(ids) > 1
    assert fast.decode(ids) == "😀" and "�" in fast.decode(ids[:1])


def test_offsets_cover_the_text(spark, edge_docs, edge_rows):
    docs = edge_docs.filter("doc_id > 0 and doc_id <> 5")
    rows = {(r.id, tuple(r.ids)): r for r in bpe.encode(docs, PATH, P.PATTERN, offsets=True).collect()}
    for (_, ids), r in rows.items():
        assert len(r.starts) == len(r.ends) == len(ids)
        assert list(r.starts) == sorted(r.starts)
    text = next(t for i, t, *_ in edge_rows if i == 8)
    r = next(r for (i, _), r in rows.items() if i == 8)
    seen = sorted({c for a, b in zip(r.starts, r.ends) for c in range(a, b)})
    assert seen == list(range(len(text)))


def test_edge_rows_round_trip(edge_docs, edge_rows, slow):
    def want(i, t):
        ids = slow.encode_ordinary(t or "")
        return (str(i), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256((t or "").encode()).hexdigest())
    got = bpe.round_trip(edge_docs, PATH, P.PATTERN).collect()
    assert sorted((str(r.id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == \
        sorted(want(r[0], r[1]) for r in edge_rows)


def test_encode_then_decode(edge_docs, edge_rows):
    back = bpe.decode(bpe.encode(edge_docs, PATH, P.PATTERN), PATH, P.PATTERN).collect()
    assert sorted((str(r.id), r.text) for r in back) == sorted((str(r[0]), r[1] or "") for r in edge_rows)


def test_null_ids_and_empty_table(spark, no_docs):
    t = spark.createDataFrame([(1, None), (2, [])], "id long, ids array<int>")
    assert {r.id: r.text for r in bpe.decode(t, PATH, P.PATTERN).collect()} == {1: None, 2: ""}
    assert bpe.round_trip(no_docs, PATH, P.PATTERN).count() == 0


def test_whole_table(spark, slow):
    docs = documents(spark)
    got = {r.id: r for r in bpe.round_trip(docs, PATH, P.PATTERN, with_ids=True).collect()}
    for r in docs.collect():
        ids = slow.encode_ordinary(r.text or "")
        assert got[r.doc_id].ids == ids and got[r.doc_id].n_tokens == len(ids)
