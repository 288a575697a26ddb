"""Queries over tables whose keys have more digits than ids hold."""

import duckdb
import pytest
from pyspark.sql import functions as F
from test_queries import SF, TABLES, ordered

from normalake.functions import law, text
from normalake.plans import queries_documents, registry
from normalake.sources import exchange, flatten


@pytest.fixture(scope="module")
def shifted(tmp_path_factory):
    """The smallest tables with part numbers on both sides of a million."""
    where, con = tmp_path_factory.mktemp("shifted"), duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        key = {"part": "p_partkey", "lineitem": "l_partkey"}.get(t)
        more = f" REPLACE ({key} + 999900 AS {key})" if key else ""
        con.execute(f"COPY (SELECT *{more} FROM '{SF}/{t}.parquet') TO '{where}/{t}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{where}/{t}.parquet'")
    return str(where), con


@pytest.mark.parametrize("name", ["val10_urn_matches_id", "snk15_exchange_annexes", "src4_checked_documents", "src4_batch_report"])
def test_parts_that_share_an_id(spark, shifted, name):
    where, con = shifted
    df = registry.queries()[name](spark, where)
    r = con.execute(registry.oracle_sql()[name])
    assert ordered(df.collect(), df.columns) == ordered(r.fetchall(), [x[0] for x in r.description])


def test_numbers_of_more_digits_than_an_id_holds(spark, shifted):
    where, con = shifted
    df = registry.queries()["src5_flatten_documents"](spark, where)
    r = con.execute(registry.oracle_sql()["src5_flatten_documents"])
    assert ordered(df.collect(), df.columns) == ordered(r.fetchall(), [x[0] for x in r.description])
    assert df.where("numero_lei = '1000008' AND lei_id LIKE '%-100000-1990'").count() > 0


def test_documents_that_share_an_id_stay_apart(spark):
    xml = '<lei><dispositivo path="art-1"><versao><texto>{}</texto></versao></dispositivo></lei>'
    docs = spark.createDataFrame([("l", xml.format("one")), ("l", xml.format("two")), ("l", xml.format("two"))], "lei_id string, xml string")
    bodies = sorted(r.xml.count("<Artigo") * 10 + r.xml.count("two") for r in exchange.documents(docs).collect())
    assert bodies == [10, 11, 11]


def test_rows_of_many_documents_come_in_bounded_frames():
    import pandas as pd

    xml = "<lei><dispositivo path='art-1'>" + "<versao em='2000-01-01'/>" * 500 + "</dispositivo></lei>"
    frame = pd.DataFrame({"lei_id": [str(i) for i in range(20)] + ["bad"], "ente": "ro", "xml": [xml] * 20 + ["<lei>"]})
    sizes = [len(f) for f in flatten._walk_all(iter([frame]))]
    assert sum(sizes) == 10_001 and max(sizes) <= 2000


def test_unparsed(spark):
    docs = spark.createDataFrame([("a", "<lei/>"), ("b", "<lei>"), ("b", None), ("c", "")], "lei_id string, xml string")
    assert sorted(r.lei_id for r in flatten.unparsed(docs).collect()) == ["b", "b", "c"]


def test_line_items_of_documents_are_shuffled_once(spark):
    docs = queries_documents.numbered_documents(spark, SF)
    assert docs._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_what_a_document_has_once_is_made_once(spark):
    """Its laws are rows before its wordings are, however many these are."""
    xml = "<lei urn-lex='urn:lex:br;x:estadual:lei:1999-06-15;9'>" + "<dispositivo path='art-1'>" + "<versao em='2000-01-01'><texto>a\u0301 \u00a0 b </texto></versao>" * 4500 + "</dispositivo></lei>"
    docs = spark.createDataFrame([("l", "ro", xml), ("bad", "ro", "<lei>"), ("empty", "ro", "<lei/>")], "lei_id string, ente string, xml string")
    assert sorted((r.lei_id, r.error is None, len(r.wordings)) for r in flatten.walked(docs).collect()) == [("bad", False, 1), ("l", True, 500), ("l", True, 2000), ("l", True, 2000)]
    rows = flatten.flatten(docs)
    assert {tuple(r) for r in rows.select("numero_lei", "texto_normalizado", "num_fontes").collect()} == {("9", "\u00e1 b", 0)} and rows.count() == 4500


def test_kinds_and_texts_of_the_walk_are_those_of_the_expressions(spark):
    paths = ["", "art-1", "art-1-a", "art-1-par-unico-inc-2-ali-b-item-3", "tit-1-cap-2", "tit-1-art-2", "titulo-lei", "art-1-titulo-lei", "ementa", "art-1-ementa", "disp-final-1", "art-\u0661", "art-1\n", "art-1\u2028", "art-1\r\n", "art-1\n\n", "xart-1", "cap-1-subsec-2", "ali-b"]
    texts = ["", " ", "a  b", "\u00a0a\t\u0085b\u3000", "e\u0301 \u2028x", "\u1100\u1161", "plain", "\u212b\u200b "]
    rows = spark.createDataFrame([(p,) for p in paths], "p string").select("p", law.path_kind(F.col("p")).alias("k")).collect()
    assert {r.p: flatten._kind(r.p) for r in rows} == {r.p: r.k for r in rows}
    want = {r.t: r.n for r in spark.createDataFrame([(t,) for t in texts if t], "t string").select("t", text.normalize_text(F.col("t")).alias("n")).collect()}
    for t, n in want.items():
        doc = f"<lei><dispositivo path='x'><versao><texto>{t}</texto></versao></dispositivo></lei>"
        row = dict(zip((f.name for f in flatten._WORDING_FIELDS), next(flatten.walk(doc)[1])))
        assert (row["texto"] if row["normal"] is None else row["normal"]) == n
