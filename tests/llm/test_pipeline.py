"""The pipeline's stages against brute force on the smallest tables, and the registration."""

import collections
import math

import pytest

import __spark_entry__
import corpus_pipeline
from tests.llm.test_operators import SCHEMA, WORD, _classes, _measured, _text, check_pieces

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Every stage's result, written and read again like in a run."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def _pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_stages(spark, stages):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    rows = _pairs(source)

    def passes(t):
        n, chars, symbols, _, repeats = _measured(t)
        return not (n < 50 or 100 * repeats > 50 * n or 10 * symbols > n or chars > 15 * n)

    rows = [r for r in rows if passes(r[1])]
    assert sorted(_pairs(stages[0])) == sorted(rows)
    last = {t: k for k, t in sorted(rows)}
    rows = [(k, t) for t, k in last.items()]
    assert sorted(_pairs(stages[1])) == sorted(rows)
    keep = {k for k, least, *_ in _classes(rows) if k == least}
    rows = [r for r in rows if r[0] in keep]
    assert sorted(_pairs(stages[2])) == sorted(rows)
    for s in stages[:4]:
        assert sorted(s.columns) == sorted(source.columns)
    check_pieces(_pairs(stages[3]), [r.asDict() for r in stages[4].collect()])


def test_mixing_stage(stages):
    before, after = stages[2].collect(), stages[3].collect()
    times = collections.Counter(r["doc_id"] for r in after)
    assert set(times) == {r["doc_id"] for r in before} and max(times.values()) <= 2
    size = lambda rows, s: sum(len(WORD.findall(_text(r["text"]))) for r in rows if r["source"] == s)
    sources = {r["source"] for r in before}
    natural = {s: size(before, s) for s in sources}
    ratio = max(natural.values()) / min(natural.values())
    a = max(0.0, 1 - math.log(2) / math.log(ratio)) if ratio > 1 else 1.0
    longest = max(len(WORD.findall(_text(r["text"]))) for r in before)
    for s in sources:
        quota = natural[s] * (max(natural.values()) / natural[s]) ** (1 - a)
        assert quota - longest - 1 <= size(after, s) <= quota + 1


def test_run_equals_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    cols = ["doc_id", "start", "length", "doc_tokens"]
    total = lambda df: df.groupBy("doc_id").sum("length").collect()
    assert sorted(total(got)) == sorted(total(stages[4]))
    assert set(cols) <= set(got.columns)


def test_empty_documents(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
