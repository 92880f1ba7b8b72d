"""The pipeline, stage by stage, against plain Python."""

import hashlib
import re

import pytest
from test_jaccard_join import brute

import corpus_pipeline
from tickloom.llm import byte_bpe, mixing, quality_rules
from tickloom.llm.common import documents, stored


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    docs, out = documents(spark, sf_dir), []
    for name, stage in corpus_pipeline.STAGES:
        result = stored(stage(spark, docs, sf_dir), name)
        out.append((docs, result))
        docs = result
    return out


def texts(df):
    return {r.doc_id: r.text or "" for r in df.collect()}


def test_stages_keep_the_columns_of_documents(steps):
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None]
    for docs, result in steps[:-1]:
        assert result.columns == docs.columns and result.count() > 0


def test_quality(spark, sf_dir, steps):
    docs, result = steps[0]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = quality_rules.classify(docs, labels).where("predicted = 1")
    assert set(texts(result)) == {r.doc_id for r in good.collect()}


def test_exact(steps):
    docs, result = steps[1]
    want = {}
    for d, t in texts(docs).items():
        want[t] = max(d, want.get(t, d))
    assert texts(result) == {d: t for t, d in want.items()}


def test_near(steps):
    docs, result = steps[2]
    assert set(texts(result)) == {c for _, c in brute(list(texts(docs).items()), 5, 80).values()}


def test_mix(steps):
    docs, result = steps[3]
    copies = {r.doc_id: r.copies for r in mixing.plan(docs).collect()}
    seen = {r.doc_id: r["count"] for r in result.groupBy("doc_id").count().collect()}
    assert seen == {d: n for d, n in copies.items() if n}
    words = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for d, t in texts(docs).items()}
    assert all(n <= 3 for n in seen.values()) and sum(words.values()) > 0


def test_tokens(steps):
    docs, result = steps[4]
    of, bpe = texts(docs), byte_bpe.load(byte_bpe.public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), byte_bpe.public_tokenizers.PATTERN)
    rows = result.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert bpe.decode(r.ids).decode() == of[r.doc_id] and r.n_tokens == len(r.ids)
        assert r.text_sha256 == hashlib.sha256(of[r.doc_id].encode()).hexdigest()


def test_run_is_the_stages_in_order(spark, sf_dir, steps):
    key = lambda r: (r.doc_id, r.n_tokens, r.text_sha256)
    assert sorted(map(key, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(key, steps[-1][1].collect()))
