"""The pipeline against the operators' brute forces, stage by stage."""
import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from conftest import SF001, documents

import corpus_pipeline as c
from reelmart.llm import bpe, mixing, quality
from reelmart.llm._common import Shared


@pytest.fixture(scope="module")
def stages(spark):
    """Name to (input, output) of each stage, each written and read again."""
    docs, shared, out = documents(spark, SF001), Shared(spark, "test"), {}
    for name, f in c.STAGES:
        new = shared.table(f(spark, docs, SF001), name)
        out[name] = (docs, new)
        docs = new
    return out


def rows(df):
    return sorted(map(str, df.collect()))


def test_shape(stages):
    assert [n for n, _ in c.STAGES] == ["quality", "lines", "simhash", "mix", "bpe"]
    for name, (old, new) in stages.items():
        if name != "bpe":
            assert new.columns == old.columns
            assert [f.dataType for f in new.schema] == [f.dataType for f in old.schema]
        assert new.count() > 0


def test_quality(stages, spark):
    old, new = stages["quality"]
    labels = {r.doc_id: quality_of(r) for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    kept = {r.doc_id for r in new.collect()}
    assert kept <= {r.doc_id for r in old.collect()}
    rated = [(labels[r.doc_id], r.doc_id in kept) for r in old.collect() if r.doc_id in labels]
    assert sum(k == (g == 2) for g, k in rated) / len(rated) > 0.95


def quality_of(r):
    return 0 if r.quality == 0 else 1 if r.toxic else 2


def test_lines(stages):
    from test_line_dedup import brute, keys

    from reelmart.llm.line_dedup import plain_bytes
    old, new = stages["lines"]
    docs, d_key = {r.doc_id: r for r in old.collect()}, keys(old)
    gone = {(i, key, pos) for (i, key, pos), (*_, kept) in brute(
        [(r.doc_id, r.text) for r in docs.values()], d_key).items()
            if not kept}
    want = {}
    for i, r in docs.items():
        drop = {p for j, k, p in gone if j == str(i) and k == d_key(i, r.text)}
        left = "\n".join(x for p, x in enumerate(r.text.split("\n")) if p not in drop)
        if not drop or plain_bytes(left).strip():
            want[i] = (left, len(left) if drop else r.n_chars)
    assert {r.doc_id: (r.text, r.n_chars) for r in new.collect()} == want


def test_simhash(stages):
    from test_simhash_neardup import classes, slow_fingerprint
    old, new = stages["simhash"]
    docs = old.collect()
    comp = classes([(r.doc_id, slow_fingerprint(r.text or "")) for r in docs])
    assert rows(new) == sorted(str(r) for r, k in zip(docs, comp) if r.doc_id == k)


def test_mix(stages):
    old, new = stages["mix"]
    want = [r.doc_id for r in mixing.mixed_documents(old).select("doc_id").collect()]
    assert sorted(r.doc_id for r in new.collect()) == sorted(want)
    from test_mixing import brute
    taken, _ = brute([(r.doc_id, r.source, r.text) for r in old.collect()])
    passes = {i: sum(1 for k in range(2) if max(0, min(n, t - k * n)) * 2 >= n > 0) for i, _, n, _, t in taken}
    got = [str(r.doc_id) for r in new.collect()]
    differ = [i for i in passes if got.count(i) != passes[i]]
    assert len(differ) <= 2 * len({r.source for r in old.collect()})  # a source's last document is split


def test_bpe(stages):
    old, new = stages["bpe"]
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(
        P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    want = sorted((r.doc_id, enc.encode_ordinary(r.text or ""), hashlib.sha256((r.text or "").encode()).hexdigest())
                  for r in old.collect())
    assert sorted((r.doc_id, r.ids, r.decoded_sha256) for r in new.collect()) == want


def test_run_and_reruns_agree(stages, spark):
    assert rows(c.run(spark, SF001)) == rows(stages["bpe"][1])


def test_each_stage_on_edge_rows(spark, edge_docs, no_docs, tmp_path):
    """Nulls, empty and long texts, repeated rows, extra columns, no rows."""
    docs = Shared(spark, "test").table(edge_docs, "edge")
    for name, f in c.STAGES:
        out = f(spark, docs, SF001)
        assert name == "bpe" or out.columns == docs.columns
        out.collect()
        assert f(spark, no_docs, SF001).count() == 0


def test_quality_reads_labels(spark):
    assert quality.fit(documents(spark, SF001), quality.grades_of(
        spark.read.parquet(f"{SF001}/labels.parquet")), 3) is not None
