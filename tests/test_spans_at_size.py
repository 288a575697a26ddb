"""Scoring and kinds without joins that load one task."""

import random

from test_queries import SF

from normalake.operators import scoring
from normalake.plans import queries_files, queries_text
from normalake.sources import generators, segmenter

SPANS = "doc long, category string, start long, end long"


def test_repeated_and_null_spans_keep_their_number(spark):
    gold = spark.createDataFrame([(1, "a", 0, 5), (1, "a", 0, 5), (1, "b", 0, 5), (None, "a", 0, 5), (2, "a", 0, 9), (2, "a", 0, 9)], SPANS)
    pred = spark.createDataFrame([(1, "a", 0, 5), (None, "a", 0, 5), (2, "a", 1, 9), (3, "b", 0, 1), (3, "b", 0, 1)], SPANS)
    n = {r.category: tuple(r)[1:] for r in scoring.counts(gold, pred).collect()}
    assert n == {"a": (5, 3, 1, 2, 4), "b": (1, 2, 0, 0, 0)}
    kinds = sorted((r.doc or 0, r.category, r.kind) for r in scoring.errors(gold, pred).collect())
    assert kinds == [(0, "a", "fn"), (0, "a", "fp"), (1, "b", "fn"), (2, "a", "boundary"), (2, "a", "fn"), (3, "b", "fp"), (3, "b", "fp")]
    plan = scoring.errors(gold, pred)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_a_text_is_segmented_once(spark):
    gold = spark.createDataFrame([(1, "Art. 1º Um.", [("art_marcador", 0, 7)])], "doc long, text string, label array<struct<category: string, start: long, end: long>>")
    figures, errors = segmenter.against_gold(gold)
    for df in (figures, errors):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("spans(") == 0
        assert "text#" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert errors.count() == 0 and {r.category: r.exact_f1 for r in figures.collect()} == {"art_marcador": 1.0, "MICRO": 1.0}


def test_years_are_joined_once_for_all_kinds(spark):
    years = spark.createDataFrame([(1, 2004), (2, 1990)], "num long, year int")
    df = generators.federal_kinds(years.select("num"), years, "b/", ["lei", "mpv"])
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    assert {(r.kind, r.num, r.url) for r in df.collect()} == {(k, r.num, r.url) for k in ("lei", "mpv") for r in generators.federal(years.select("num"), years, "b/", k).collect()}


def test_figures_within_documents_are_those_of_joins(spark):
    """Repeated documents and spans, nulls, empty and turned spans, far places."""
    draw = random.Random(5)
    place = lambda: draw.choice([None, -(2**62), 2**62, *range(12), *range(12)])
    some = lambda: None if draw.random() < 0.1 else [(draw.choice(["a", "a", "b", None]), place(), place()) for _ in range(draw.randint(0, 9))]
    each = "array<struct<category: string, start: long, end: long>>"
    for docs in (list(range(60)), [*range(30), *range(20), None, None]):
        rows = spark.createDataFrame([(d, some(), some()) for d in docs], f"doc long, label {each}, found {each}")
        side = lambda n: rows.selectExpr("doc", f"inline({n})")
        assert sorted(map(repr, scoring.counts_by_doc(rows).collect())) == sorted(map(repr, scoring.counts(side("label"), side("found")).collect()))


def test_only_figures_are_shuffled(spark):
    gold = spark.createDataFrame([(1, "Art. 1º Um.", [("art_marcador", 0, 7)])], "doc long, text string, label array<struct<category: string, start: long, end: long>>")
    plan = segmenter.against_gold(gold)[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Expand" not in plan


def test_texts_are_dealt_to_all_tasks(spark):
    assert queries_text.norm_texts(spark, SF).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_gold_made_of_what_is_found_needs_no_second_pass(spark):
    plan = queries_files._off_gold(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Join" not in plan and "text#" not in plan.splitlines()[0]


def test_spans_of_some_categories_and_sentences(spark):
    text = "Art. 1º A Sra. Lima, n. 5, fica. Revogam-se as disposições do art. 3. Art. 2º Esta Lei entra em vigor.\nRevogados os "
    every = segmenter.spans(text)
    assert [text[a:b] for k, a, b in every if k in ("revogacao", "vigencia")] == ["Revogam-se as disposições do art. 3.", "Art. 2º Esta Lei entra em vigor."[9 - 1 :]]
    for k in segmenter.CATEGORIES:
        assert segmenter.spans(text, {k}) == [s for s in every if s[0] == k]
