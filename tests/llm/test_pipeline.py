"""The pipeline against its stages' brute-force results on a small corpus."""

import random

import pytest

import corpus_pipeline
from normalake.llm import langid


@pytest.fixture(scope="module")
def corpus(tmp_path_factory, spark):
    rng = random.Random(5)
    speak = {"en": "the and of to with nation being", "fr": "le la que aux des moment eau"}
    make = lambda k, n: " ".join(rng.choice(speak[k].split()) + str(rng.choice(["", "x", "y", "z", "q"])) for _ in range(n))
    texts = [(k, make(k, rng.choice([20, 120]))) for _ in range(60) for k in speak]
    leak = "a question about seven green lamps that burn all night in the old tower"
    near = texts[0][1].split()
    while len(near) < 100:
        near += make("en", 20).split()
    texts[0] = ("en", " ".join(near))
    near[50] = "other"
    extra = [("en", " ".join(near)), ("en", texts[4][1] + " "), ("fr", f"{texts[3][1]} {leak.upper()}"), (None, "12 34 !!"), (None, None)]
    d = str(tmp_path_factory.mktemp("sf"))
    rows = [(i, t, k, f"s{i % 5}", 1) for i, (k, t) in enumerate(texts + extra)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, {r[0]: r for r in rows}, len(texts)


def test_exact_stage_leaves_one_row_of_repeats(spark, corpus):
    """Repeated rows, rows that differ in other columns, clashing names."""
    rows = [(1, "a  b", "x"), (1, "ab", "y"), (2, "zz", "p"), (2, "zz", "q"), (2, "zz", "q"), (None, "n", "r"), (None, "n", "r"), (3, None, "s"), (4, "", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _n string").selectExpr("*", "_n AS best", "1 AS _sha")
    got = corpus_pipeline.exact(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "", r._n) for r in got.collect()) == [(0, "n", "r"), (1, "a  b", "x"), (2, "zz", "p"), (3, "", "s")]
    assert corpus_pipeline.exact(spark, docs.where("false"), "").count() == 0


def test_stages_take_effect(spark, corpus, tmp_path):
    d, rows, n = corpus
    docs, left = spark.read.parquet(f"{d}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, d)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        left[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    names = [k for k, _ in corpus_pipeline.STAGES]
    assert set(rows) - left[names[0]] == {n + 3, n + 4}
    # the longer text stays
    assert left[names[0]] - left[names[1]] == {4}
    assert left[names[1]] - left[names[2]] == {n}
    assert left[names[2]] - left[names[3]] == {n + 2}
    assert left[names[3]] == left[names[4]]
    assert {r.doc_id for r in corpus_pipeline.run(spark, d).collect()} == left[names[4]]
    assert langid.fit(spark.read.parquet(f"{d}/documents.parquet"))["names"] == ["en", "fr"]


def test_stages_of_awkward_tables(spark, corpus, tmp_path):
    """Every stage on no rows, without a benchmark, and on nulls, repeated rows,
    ties, a very long text and clashing names."""
    d = corpus[0]
    bare = str(tmp_path / "sf")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{bare}/benchmark.parquet")
    like = spark.read.parquet(f"{d}/documents.parquet")
    for where in (d, bare):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, like.where("false"), where).count() == 0
    text = "the and of to with nation being " * 30
    rows = [(1, text, "en", "s"), (1, text, "en", "s"), (2, text + " ", "en", None), (None, text.upper(), None, "s"), (3, "la que aux des moment eau " * 5000, "fr", "s"), (4, None, "en", "s"), (None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "1 AS lang_pred", "2 AS _id", "3 AS n", "4 AS _c0", "5 AS block")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, bare)
        assert out.columns == docs.columns and out.count() <= docs.count()
        out.write.mode("overwrite").parquet(str(tmp_path / stage.__name__))
        docs = spark.read.parquet(str(tmp_path / stage.__name__))
    assert {r.doc_id for r in docs.collect()} - {None} == {2, 3}
    assert {r.doc_id for r in corpus_pipeline.packed(spark, docs, bare).collect()} - {None} == {2, 3}


def test_exact_stage_takes_columns_that_have_no_order(spark):
    docs = spark.createDataFrame([(1, "same text", {"a": 1}), (1, "same text", {"b": 2}), (2, "same text", {"c": 3}), (3, "other", None)], "doc_id long, text string, info map<string, int>")
    got = corpus_pipeline.exact(spark, docs, "").collect()
    assert sorted(r.doc_id for r in got) == [1, 3] and docs.schema == corpus_pipeline.exact(spark, docs, "").schema
