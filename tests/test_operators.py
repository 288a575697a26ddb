"""Operators on small cases that the tables do not reach."""

import pytest
from pyspark.sql import functions as F

from normalake.functions import law
from normalake.operators import captures, ledger, provisions, quality, scoring, search
from normalake.sources import files, parse, publish, tables

NODES = "lei_id string, dispositivo_path string, dispositivo_parent_path string, dispositivo_ordem int, versao_id string, em date, ate date"


def nodes(spark, rows):
    return spark.createDataFrame([(a, p, q, o, f"{a}{p}", None, None) for a, p, q, o in rows], NODES)


def test_trees_of_any_depth_and_cycles(spark):
    """15 levels, a cycle of two with one that hangs on it, a node that is its
    own parent, a missing parent."""
    deep = [("a", f"p{i}", f"p{i - 1}" if i else None, 0) for i in range(15)]
    odd = [("b", "x", "y", 0), ("b", "y", "x", 0), ("b", "z", "x", 1), ("b", "own", "own", 2), ("b", "lost", "nowhere", 3)]
    got = {(r.lei_id, r.dispositivo_path): (r.depth, r.sort_key) for r in provisions.ordered_tree(nodes(spark, deep + odd)).collect()}
    assert len(got) == 20
    assert [got["a", f"p{i}"][0] for i in range(15)] == list(range(15))
    assert got["a", "p14"][1].count("/") == 14
    assert got["b", "x"] == got["b", "y"] == got["b", "z"] == (None, None)
    assert got["b", "own"][0] == got["b", "lost"][0] == 0
    assert provisions.ordered_tree(nodes(spark, [])).count() == 0


def test_nearest_ancestor_at_any_depth(spark):
    rows = [("a", f"p{i}", f"p{i - 1}" if i else None, "top" if i == 0 else "mid" if i == 9 else None) for i in range(25)]
    rows += [("b", "x", "y", None), ("b", "y", "x", None), ("b", "z", "x", None), ("c", "u", "w", "here"), ("c", "w", "u", None), ("d", "k", "nowhere", "own")]
    df = spark.createDataFrame(rows, "lei_id string, path string, parent string, v string")
    got = {(r.lei_id, r.path): r.inherited for r in provisions.nearest_ancestor(df, "v").collect()}
    assert got["a", "p0"] is None and got["a", "p9"] == "top" and got["a", "p10"] == got["a", "p24"] == "mid"
    assert got["b", "x"] is got["b", "y"] is got["b", "z"] is None
    assert got["c", "w"] == "here" and got["c", "u"] == "here" and got["d", "k"] is None and len(got) == len(rows)


def test_append_takes_equal_rows_of_a_batch_once(spark):
    kind = "tipo string, numero string, rendicao string, formato string, sha256 string, source string"
    row = ("lei", "1", "original", "pdf", "aa", "s1")
    index = spark.createDataFrame([("lei", "2", "original", "pdf", "bb", "s1")], kind)
    batch = spark.createDataFrame([row, row, ("lei", "1", "original", "pdf", "aa", "s2"), ("lei", "2", "original", "pdf", "bb", "s9"), ("", "", "original", "pdf", "cc", "s1"), ("", "", "original", "pdf", "cc", "s2")], kind)
    once = captures.append(index, batch)
    assert once.count() == 4
    assert captures.append(once, batch).count() == 4


def test_representative_puts_nulls_last(spark):
    rows = [("a", None, 1, "v1"), ("a", "art-1", None, "v2"), ("a", "art-2", 2, "v3"), ("b", "art-1", 0, "v4"), ("b", "ementa", 9, "v5"), ("c", None, None, "v6")]
    df = spark.createDataFrame(rows, "lei_id string, dispositivo_path string, dispositivo_ordem int, versao_id string")
    assert {r.lei_id: r.versao_id for r in search.representative(df).collect()} == {"a": "v1", "b": "v5", "c": "v6"}
    assert search.valid_year("1998") == 1998 and search.valid_year("1850") is None and search.valid_year("") is None


def test_first_object_goes_on_after_a_list():
    assert parse.first_object('[{"a": 1}, 2]') == {"a": 1}
    assert parse.first_object("[1, 2]") is None and parse.first_object('x {"b": 2} y') == {"b": 2}


@pytest.mark.parametrize("raw, day", [("20200102", "2020-01-02"), ("2020-01-02Z", "2020-01-02"), ("2020-W01-4", "2020-01-02"), ("2020W014", "2020-01-02"), ("2020-W01", "2019-12-30"), ("2020-W53-7", "2021-01-03"), ("2021-W53-1", None), ("2020-W00-1", None), ("20201301", None), ("2020-1-2", None), ("", None), (None, None)])
def test_dates(spark, raw, day):
    got = spark.createDataFrame([(raw,)], "d string").select(law.parse_date(F.col("d")).alias("d")).first().d
    assert (got and got.isoformat()) == day


def test_labels(spark):
    paths = {"titulo-lei": "Título da lei", "art-1-item-3": "Art. 1º › item 3", "disp-transitoria-1": "Disposição Transitória 1", "disp-final-2-par-unico": "Disposição Final 2 › Parágrafo único"}
    df = spark.createDataFrame(list(paths.items()), "path string, want string").select("want", law.breadcrumb(F.col("path")).alias("got"))
    assert all(r.want == r.got for r in df.collect())


def test_rules_by_id_and_kind(spark):
    ids = ["raw-ro-portal-lei-1", "norma-raw-ro-portal-lei-1", "raw-1", "raw-ro-lei", ""]
    df = spark.createDataFrame([(f"f{i}", f'[{{"ia_id": "{x}"}}]') for i, x in enumerate(ids)], "lei_id string, fontes string")
    assert {r.file for r in quality.source_ids(df).collect()} == {"f2", "f3", "f4"}
    urn = "urn:lex:br;rondonia:estadual:lei:1990-05-01"
    cases = {
        "norma-ro-lei-00042-1990": (f"{urn};42", set()), "norma-ro-lei-00042-1991": (f"{urn};42", {"ano"}), "norma-ro-lc-00043-1990": (f"{urn};42", {"tipo", "numero"}), "norma-ro-lei-00044-1990": (urn, {"numero"}),
        "norma-ro-lei-00045-1990": (None, {"urn"}), "other": (f"{urn};1", set()), "norma-ro-lei-fallback-p-x": (None, set()), "norma-ro-lei-00046-1990": ("urn:odd", set()),
    }
    found = quality.urn_matches_id(spark.createDataFrame([(k, u) for k, (u, _) in cases.items()], "lei_id string, urn_lex_lei string")).collect()
    assert {(r.file, r.message) for r in found} == {(k, m) for k, (_, ms) in cases.items() for m in ms}
    padded = spark.createDataFrame([(n, f"{urn};{n}") for n in ("007", "012345", "0", "7", "00000000012")], "lei_id string, urn_lex_lei string")
    assert {r.file for r in quality.urns(padded).collect()} == {"007", "0", "00000000012"}
    code = lambda rules: quality.summary(spark.createDataFrame([("f", r) for r in rules], "file string, rule string")).first().exit_code
    assert (code([]), code(["VAL3"]), code(["VAL3", "VAL0"])) == (0, 1, 2)


def test_pairing_of_nested_and_repeated_spans(spark):
    kind = "doc int, category string, start long, end long"
    gold = spark.createDataFrame([(1, "a", 0, 100), (1, "a", 5, 10), (1, "a", 200, 210), (2, "a", 0, 3)], kind)
    pred = spark.createDataFrame([(1, "a", 1, 2), (1, "a", 6, 9), (1, "a", 50, 60), (1, "a", 205, 300), (2, "b", 0, 3)], kind)
    got = sorted((r.doc, r.category, r.kind, r.start, r.end, r.pred_start) for r in scoring.errors(gold, pred).collect() if r.kind != "fp")
    assert got == [(1, "a", "boundary", 0, 100, 1), (1, "a", "boundary", 5, 10, 6), (1, "a", "boundary", 200, 210, 205), (2, "a", "fn", 0, 3, None)]


def test_numbering_and_pool(spark, tmp_path):
    df = spark.range(500).selectExpr("concat('n', (id * 7919) % 500) AS name")
    got = publish.numbered(df.repartition(7), "name", "place").collect()
    assert [r.name for r in sorted(got, key=lambda r: r.place)] == sorted(r.name for r in got) and {r.place for r in got} == set(range(1, 501))
    assert publish.write_pool(df, str(tmp_path / "pool")) == 500 and spark.read.json(str(tmp_path / "pool")).count() == 500
    publish.write_manifest(spark.createDataFrame([("b", 3, 1), ("a", 2, 2)], "source string, available int, picked int"), str(tmp_path / "m"), seed=42)
    assert spark.read.json(str(tmp_path / "m"), multiLine=True).select("seed", "available", "picked", F.size("sources")).first()[:] == (42, 5, 3, 2)


def test_robots_without_rules_or_host(spark):
    urls = spark.createDataFrame([("https://a.example/x",), ("https://b.example/x",), ("no-scheme",), ("https://a.example",)], "url string")
    robots = spark.createDataFrame([("a.example", "Disallow: /\nUser-agent: *\nDisallow: /x")], "host string, text string")
    assert {r.url: r.allowed for r in files.robots_allowed(urls, robots, "crawler").collect()} == {"https://a.example/x": False, "https://b.example/x": True, "no-scheme": False, "https://a.example": True}


def test_stored_views_follow_their_inputs(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(3).write.parquet(path)
    view = lambda: tables.stored_once(spark, "v", [path], lambda: spark.read.parquet(path)).count()
    assert view() == view() == 3
    spark.range(5).write.mode("overwrite").parquet(path)
    assert view() == 5
    kept = tables.stored(spark.range(4))
    assert kept.count() == 4
    tables.dropped(kept, kept)


def test_stored_tables_are_released_and_swept(spark):
    with tables.released():
        a = tables.stored(spark.range(3))
        where = a._stored_at
        assert a.count() == 3
    path, fs = tables._path(spark, where)
    assert not fs.exists(path)
    b = tables.stored(spark.range(2))
    name = b._stored_at.rpartition("/")[2]
    assert name not in tables.swept(spark, 1) and b.count() == 2
    assert name in tables.swept(spark, -1)


def test_hosts_are_paced(spark):
    rows = spark.createDataFrame([("a", "1"), ("a", "3"), ("a", "2"), ("b", "9"), (None, "5")], "host string, url string")
    assert {(r.host, r.url): r.wait for r in ledger.paced(rows, "host", "url", 2.0).collect()} == {("a", "1"): 0.0, ("a", "2"): 2.0, ("a", "3"): 4.0, ("b", "9"): 0.0, (None, "5"): 0.0}
