"""Documents to versions, sinks, parsing, segmentation, streaming."""

import datetime
import glob
import json

import pytest
from pyspark.sql import functions as F

from normalake.operators import captures, ledger, provisions, quality, scoring
from normalake.schema import EXPORT_COLUMNS, VERSIONS
from normalake.sources import files, flatten, parse, publish, segmenter
from normalake.streaming import ledger as streams

D = datetime.date
XML = """<lei xmlns="urn:x" schema-version="0.1" urn-lex="urn:lex:br;rondonia:estadual:lei:1999-06-15;9999" vigente-em="2024-01-01">
<dispositivo path="ementa"><versao><texto>Summary</texto><fonte ia-id="raw-ro-p-1"/></versao></dispositivo>
<dispositivo path="art-1"><versao em="2003-06-15"><texto>One  é</texto><fonte ia-id="raw-ro-p-1"/><fonte ia-id="raw-ro-p-2" diverge=" TRUE "><texto>Uno</texto></fonte></versao>
<versao em="2018-04-10" alterado-por="l2"><inicio tipo="vacatio-legis"/><texto>Two</texto></versao><versao em="bad"><texto/></versao>
<dispositivo path="art-1-par-unico"><versao><texto>Sole</texto></versao></dispositivo></dispositivo>
<dispositivo path="art-2"><versao><texto>Gone</texto></versao><revogacao em="2015-03-01Z" por="l3" tipo="expressa"/>
<dispositivo path="art-2-par-1"><versao><texto>Child</texto></versao></dispositivo></dispositivo></lei>"""


@pytest.fixture(scope="module")
def versions(spark):
    docs = spark.createDataFrame([("norma-ro-lei-09999-1999", "ro", XML), ("norma-ro-dec-fallback-p-x-1-2000", "ro", "<lei><dispositivo path='zz'><versao/></dispositivo></lei>"), ("bad", "ro", "<lei>"), ("none", "ro", None)], "lei_id string, ente string, xml string")
    return flatten.consolidate(docs).cache(), docs


def test_flatten(versions):
    df, docs = versions
    assert df.schema.names == VERSIONS.names and [f.dataType for f in df.schema] == [f.dataType for f in VERSIONS]
    rows = {r.versao_id.split("#", 1)[1]: r for r in df.where("lei_id LIKE '%9999-1999'").collect()}
    assert set(rows) == {"ementa#1999-06-15", "art-1#2003-06-15", "art-1#2018-04-10", "art-1#unknown", "art-1-par-unico#2003-06-15", "art-2#1999-06-15", "art-2-par-1#1999-06-15"}
    r = rows["art-1#2003-06-15"]
    assert (r.em, r.ate, r.num_fontes, r.tem_divergencia, r.texto_normalizado, r.inicio_tipo) == (D(2003, 6, 15), D(2018, 4, 10), 2, True, "One é", "data-publicacao")
    assert json.loads(r.fontes)[1] == {"ia_id": "raw-ro-p-2", "diverge": True, "texto_divergente": "Uno"}
    # the next wording's start ends this one even if it is unknown
    assert rows["art-1#2018-04-10"].ate is None and rows["art-1#2018-04-10"].inicio_tipo == "vacatio-legis"
    assert rows["art-1#unknown"].hash_texto is None and rows["art-1#unknown"].texto_normalizado is None
    r = rows["art-1-par-unico#2003-06-15"]
    assert (r.dispositivo_parent_path, r.dispositivo_ordem, r.dispositivo_tipo) == ("art-1", 0, "paragrafo")
    assert rows["art-2#1999-06-15"].ate == rows["art-2-par-1#1999-06-15"].ate == D(2015, 3, 1)
    assert rows["art-2#1999-06-15"].dispositivo_revogado and not rows["art-2-par-1#1999-06-15"].dispositivo_revogado
    r = rows["ementa#1999-06-15"]
    assert (r.tipo_lei, r.numero_lei, r.ano_lei, r.data_publicacao, r.urn_dispositivo, r.ate) == ("lei", "9999", 1999, D(1999, 6, 15), r.urn_lex_lei + "!ementa", None)
    r = df.where("lei_id LIKE '%fallback%'").first()
    assert (r.tipo_lei, r.numero_lei, r.ano_lei, r.dispositivo_tipo, r.versao_id, r.fontes) == ("dec", None, 0, "desconhecido", "norma-ro-dec-fallback-p-x-1-2000#zz#unknown", "[]")
    assert {r.lei_id for r in flatten.walked(docs).where("error IS NOT NULL").collect()} == {"bad", "none"}


def test_law_revocation_ends_everything_and_duplicates_fail(spark):
    xml = "<lei><revogacao em='2010-01-01' tipo='tacita'/><dispositivo path='art-1'><versao em='2000-01-01'><texto>a</texto></versao></dispositivo></lei>"
    df = spark.createDataFrame([("norma-ro-lei-00007-2000", "ro", xml)], "lei_id string, ente string, xml string")
    r = flatten.flatten(df).first()
    assert (r.ate, r.lei_revogada, r.lei_revogada_tipo, r.tipo_lei, r.numero_lei, r.ano_lei) == (D(2010, 1, 1), True, "tacita", "lei", "7", 2000)
    with pytest.raises(ValueError, match="Duplicate versao_id"):
        flatten.consolidate(df.union(df))


def test_sinks_round_trip(spark, versions, tmp_path):
    df, _ = versions
    publish.write_versions(df, str(tmp_path / "p"), 2)
    back = files.versions_parquet(spark, str(tmp_path / "p"), "versoes_t")
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    with pytest.raises(ValueError):
        publish.write_versions(df.where("false"), str(tmp_path / "q"))
    meta = json.loads(publish.dataset_meta(spark, str(tmp_path / "p"), "v1", "2024-01-01T00:00:00Z"))
    assert meta["row_count"] == df.count() and meta["hash_parquet"].startswith("sha256:") and "git_sha" not in meta
    assert publish.triggers(spark, str(tmp_path / "p"), 2000, most_rows=3) == ["rows", "latency"]
    df.write.json(str(tmp_path / "j"))
    again = files.versions_json(spark, str(tmp_path / "j"))
    assert again.schema.names == VERSIONS.names and sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    assert list(json.loads(publish.rows_json(df).first().json)) == EXPORT_COLUMNS
    publish.write_csv(df.coalesce(1).limit(2).withColumn("texto", F.lit('a "q", b')), str(tmp_path / "c"))
    raw = open(glob.glob(str(tmp_path / "c" / "part-*"))[0], newline="").read()
    assert raw.endswith("\r\n") and '"a ""q"", b"' in raw and raw.split("\r\n")[0] == ",".join(EXPORT_COLUMNS)
    xml = {r.lei_id: r.xml for r in publish.lexml(df).collect()}["norma-ro-lei-09999-1999"]
    assert 'id="art1_par1u"' in xml and xml.index('id="art1"') < xml.index('id="art1_par1u"') < xml.index('id="art2"') and "<p>Two</p>" in xml
    assert publish.export_laws(spark.createDataFrame([("a", "ro", 1999)], "id string, ente string, ano int"), str(tmp_path), "ro", 1999).endswith("normas-ro-1999.parquet")


def test_provisions_and_rules(versions):
    df, _ = versions
    tree = {r.dispositivo_path: (r.is_root, r.depth) for r in provisions.ordered_tree(df.where("lei_id LIKE '%9999-1999'")).collect()}
    assert tree == {"ementa": (True, 0), "art-1": (True, 0), "art-1-par-unico": (False, 1), "art-2": (True, 0), "art-2-par-1": (False, 1)}
    assert {r.dispositivo_path for r in provisions.history(df).collect()} == {"art-1", "art-2", "art-2-par-1"}
    found = {(r.rule, r.message) for r in quality.violations(df).collect()}
    assert ("VAL4", "zz: unknown path") in found and ("VAL17", "norma-ro-lei-09999-1999#art-1#2003-06-15") in found
    assert not {m for k, m in found if k == "VAL1"}


def test_files(spark, tmp_path):
    (tmp_path / "i.csv").write_text("tipo,numero,sha256\nlei,5120,h1\nlei,,h2\n")
    rows = files.capture_index(spark, str(tmp_path / "i.csv")).collect()
    assert [(r.tipo, r.numero, r.source) for r in rows] == [("lei", "5120", ""), ("lei", "", "")]
    (tmp_path / "l.json").write_text('{"names": ["O", "ementa"]}')
    (tmp_path / "m.json").write_text('{"names": ["ementa", "O"]}')
    assert files.label_space(spark, str(tmp_path / "l.json")) == ["O", "ementa"]
    with pytest.raises(ValueError):
        files.label_space(spark, str(tmp_path / "m.json"))
    (tmp_path / "src.json").write_text(json.dumps({"ente": "ro", "fontes": {"portal": {"tipo_ingestion": "pdf", "discovery": [{"strategy": "seq", "start": 1, "end": 9}, {"strategy": "index", "url": "u"}]}}}))
    assert [(r.fonte, r.strategy, r.start) for r in files.manifest_probes(spark, str(tmp_path / "src.json")).collect()] == [("portal", "seq", 1), ("portal", "index", None)]
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "norma-ro-lei-1-2000.xml").write_text("<lei/>")
    assert tuple(files.xml_documents(spark, str(tmp_path / "x"), "ro").first()) == ("norma-ro-lei-1-2000", "ro", "<lei/>")
    html = "<a href='Files/L6001.pdf'>a</a><A HREF=Files/Res3.PDF>b</A><a href='x.html'>c</a><a href='Files/L6001.pdf'>"
    links = files.html_links(spark.createDataFrame([("https://h.example/i/index.html", html)], "url string, html string"), "url")
    assert {r.link for r in links.collect()} == {"https://h.example/i/Files/L6001.pdf", "https://h.example/i/Files/Res3.PDF"}


def test_ledger_and_captures(spark):
    old = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "k string, v string, n int")
    new = spark.createDataFrame([("a", None, 9), ("c", "z", 9)], "k string, v string, n int")
    assert {tuple(r) for r in ledger.insert_or_replace(old, new, "k", ["v"]).collect()} == {("a", None, 1), ("b", "y", 2), ("c", "z", None)}
    assert {tuple(r) for r in ledger.insert_or_ignore(old, new.union(new.withColumn("v", F.lit("late")).withColumn("n", F.lit(10))), "k", "n").collect()} == {("a", "x", 1), ("b", "y", 2), ("c", "z", 9)}
    cols = "tipo string, numero string, rendicao string, formato string, uuid5 string, sha256 string, captured_at string, source string"
    idx = spark.createDataFrame([("lc", "42", "", "pdf", "u1", "pdf1", "t", "s1"), ("", "", "", "pdf", "u2", "h2", "t", "s2"), ("", "", "", "pdf", "u2", "h2", "t", "s3")], cols)
    again = captures.append(idx, idx)
    assert again.count() == 3
    known = spark.createDataFrame([("s2", "lei", "7")], "source string, tipo string, numero string")
    index, holding = captures.reconcile(idx.where("numero = ''"), known, idx.where("numero != ''"))
    assert {(r.tipo, r.numero, r.sha256) for r in index.collect()} == {("lc", "42", "pdf1"), ("lei", "7", "h2")} and [r.source for r in holding.collect()] == ["s3"]


TEXT = "LEI Nº 1, DE 1999. Dispõe sobre a lei. O PRESIDENTE faz saber: Art. 1º Fica criado. § 1º Nos termos do § 2º do art. 3. Parágrafo único. I - um; a) dois. Art. 3º Esta Lei entra em vigor na data. Art. 2º Revogam-se as disposições em contrário."


def test_segmenter(spark):
    got = [(k, TEXT[a:b]) for k, a, b in segmenter.spans(TEXT)]
    assert ("ementa", "Dispõe sobre a lei.") in got and [t for k, t in got if k == "art_marcador"] == ["Art. 1º", "Art. 3º", "Art. 2º"]
    assert [t for k, t in got if k == "par_marcador"] == ["§ 1º", "Parágrafo único"] and ("inc_marcador", "I -") in got and ("ali_marcador", "a)") in got
    assert ("vigencia", "Esta Lei entra em vigor na data.") in got and ("revogacao", "Revogam-se as disposições em contrário.") in got
    found = segmenter.structure(spark.createDataFrame([(1, TEXT), (2, None), (3, "Art. 1º x. Art. 4º y.")], "doc long, text string")).collect()
    assert {(r.doc, r.kind, tuple(r.numbers)) for r in found} == {(1, "out_of_order", (2,)), (2, "no_articles", ()), (2, "no_ementa", ()), (2, "no_vigencia", ()), (3, "missing_articles", (2, 3)), (3, "no_ementa", ()), (3, "no_vigencia", ())}


def test_scoring(spark):
    s = "doc long, category string, start long, end long"
    gold = spark.createDataFrame([(1, "a", 0, 10), (1, "a", 20, 30), (1, "b", 5, 6)], s)
    pred = spark.createDataFrame([(1, "a", 0, 10), (1, "a", 25, 40), (1, "c", 0, 9)], s)
    m = {r.category: r for r in scoring.metrics(scoring.counts(gold, pred)).collect()}
    assert (m["a"].exact_p, m["a"].overlap_r, m["b"].exact_f1, m["c"].gold) == (0.5, 1.0, 0.0, 0)
    assert (m["MICRO"].gold, m["MICRO"].pred, m["MICRO"].exact_tp) == (3, 3, 1)
    assert {(r.kind, r.category, r.start, r.pred_start) for r in scoring.errors(gold, pred).collect()} == {("boundary", "a", 20, 25), ("fn", "b", 5, None), ("fp", "c", None, 0)}
    assert scoring.errors(gold, gold).count() == 0


def test_parse_tools(spark):
    assert parse.first_object('{"a": 1}') == {"a": 1} and parse.first_object('x {bad} {"b": 2} y') == {"b": 2} and parse.first_object("[1]") is None and parse.first_object(None) is None
    ok = {"confidence": 0.5, "tipo": "lei", "numero": "7", "ano": 1999}
    assert parse.accepted(ok) and not any(parse.accepted(ok | x) for x in ({"confidence": float("nan")}, {"confidence": 0.4}, {"numero": "7a"}, {"ano": None}, {"tipo": ""}))
    rows = spark.createDataFrame([("1", "t"), ("2", None)], "id string, text string")
    got = parse.parse(rows, lambda t: '{"confidence": 1, "tipo": "lei", "numero": "7", "ano": 1999}' if t else "none").collect()
    assert {(r.id, r.ok) for r in got} == {("1", True), ("2", False)}
    assert parse.occurrence("aaaa", "aa", 3) == (2, 4) and parse.occurrence("aaaa", "aa", 4) is None
    assert parse.preview("abcd", [{"category": "x", "start": 1, "end": 3}]) == "a[x: bc]d"
    recs = spark.createDataFrame([(1, "abc", [("x", 0, 2), ("y", 0, 1), ("x", 2, 9)])], "doc int, text string, label array<struct<category:string,start:int,end:int>>")
    assert {(r.category, r.why) for r in parse.invalid_spans(recs, ["x"]).collect()} == {("y", "unknown category"), ("x", "bad offsets")}


def test_retry():
    waits, said = [], iter([(False, "Please reduce your request rate"), (False, "503"), (True, "")])
    assert publish.with_retry(lambda: next(said), sleep=waits.append) and 2 <= waits[0] <= 2.5 and 4 <= waits[1] <= 5
    assert not publish.with_retry(lambda: (False, "denied"), sleep=waits.append) and len(waits) == 2
    assert "failure rate 50.0 % (over the limit)" in publish.summary({"ok": 1, "failed": 1})


def test_streams_resume(spark, tmp_path):
    src, out, state = (str(tmp_path / x) for x in ("src", "out", "state"))
    spark.createDataFrame([("u1", 1), ("u1", 2), ("u2", 1)], "url string, n long").write.parquet(src)
    run = lambda: streams.upsert_batches(streams.source(spark, src), out, "url", "n", f"file://{state}").awaitTermination()
    run()
    spark.createDataFrame([("u2", 5), ("u3", 5)], "url string, n long").write.mode("append").parquet(src)
    run()
    run()
    assert {tuple(r) for r in streams.ledger_rows(spark, out).collect()} == {("u1", 1), ("u2", 1), ("u3", 5)}
