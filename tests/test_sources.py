"""Listings, manifests, annotation, checked documents, exchange, parse, digests."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from normalake.functions import identity as I
from normalake.operators import captures, provisions, scoring, search
from normalake.sources import annotation, exchange, files, flatten, generators, listings, parse, publish, segmenter

ROWS = [["urlkey", "timestamp", "original", "statuscode"], ["k", "20240101000000", "http://a.example/L12.pdf", "200"], ["k", "20240101000001", "https://a.example/x[1], y].pdf", "200"], ["k", "2", "https://a.example/L13.pdf", "404"]]


@pytest.mark.parametrize("text", [json.dumps(ROWS), json.dumps(ROWS).replace('], ["k"', '],\n["k"'), "[" + ",\n ".join(json.dumps(r) for r in ROWS) + "\n]\n", json.dumps(ROWS) + "\nnot json\n[1, 2\n"])
def test_listing_files_of_any_layout(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    (tmp_path / "b.json").write_text('[["original", "length"],\n["http://b.example/D7.PDF", "9"]]')
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "headless.json").write_text('[["k", "v"]]')
    got = {r.original: (r.timestamp, r.statuscode, r.length) for r in listings.archive_listing(spark, str(tmp_path)).collect()}
    assert got == {ROWS[1][2]: ("20240101000000", "200", None), ROWS[2][2]: ("20240101000001", "200", None), ROWS[3][2]: ("2", "404", None), "http://b.example/D7.PDF": (None, None, "9")}
    found, failed = listings.discover(spark, [{"strategy": "wayback-cdx", "path": str(tmp_path), "prefix": "https://a.example"}, {"strategy": "sequential", "template": "t{num}", "start": 1, "end": "x"}], "ro", "p")
    assert {(r.url, r.tipo_documento, r.chave) for r in found.collect()} == {("https://a.example/L12.pdf", "lei", "lei-00012"), ("https://a.example/x[1], y].pdf", "", "documento-x[1], y]")} and list(failed) == ["sequential"]
    with pytest.raises(ValueError, match="unknown strategies"):
        listings.discover(spark, [{"strategy": "guess"}], "ro", "p")


def test_offsets_of_quoted_text(spark):
    kind = "doc int, text string, spans array<struct<category: string, start: long, end: long>>, finds array<struct<category: string, match: string, nth: long>>"
    finds = [("a", "aa", None), ("b", "aa", 3), ("c", "aa", 4), ("d", "", 1), ("e", "a", 0), ("f", "é", 2), ("g", None, 1), ("h", "a", 10**12)]
    rows = [(1, "aaaa é 🙂é", [("x", 0, 1)], finds), (2, None, None, finds), (3, "b", None, None), (4, "", [], [("a", "a", 1)])]
    found, lost = annotation.from_spans(spark.createDataFrame(rows, kind))
    got = {r.doc: [tuple(s) for s in r.label] for r in found.collect()}
    assert got == {1: [("x", 0, 1), ("a", 0, 2), ("b", 2, 4), ("f", 8, 9)], 3: [], 4: []}
    assert {(r.doc, r.category) for r in lost.collect()} == {(1, k) for k in "cdegh"} | {(4, "a")}
    for text, needle, n in [("aaaa", "aa", 3), ("abcab", "ab", 2), ("x", "y", 1)]:
        at = spark.createDataFrame([(text, needle, n)], "t string, m string, n long").select(annotation.nth_position("t", "m", "n")).first()[0]
        assert (None if at is None else (at, at + len(needle))) == parse.occurrence(text, needle, n)


def test_pools_skip_short_texts_without_replacing_them(spark):
    rows = spark.createDataFrame([(f"r{i}", "ro" if i < 8 else None, "p", "x" * (i * 60) if i % 4 else None) for i in range(12)], "raw_id string, ente string, fonte string, text string")
    records, manifest = annotation.annotation_pool(rows, 3, least=100)
    by = {r.ente: (r.available, r.picked, r.kept, r.skipped) for r in manifest.collect()}
    assert by["ro"][:2] == (8, 3) and by[None][:2] == (4, 3) and all(v[1] == v[2] + v[3] for v in by.values())
    assert records.count() == sum(v[2] for v in by.values()) and records.where("size(label) > 0 OR length(text) < 100").count() == 0


def test_checked_documents(spark, tmp_path):
    sound = "<lei><dispositivo path='art-1'><versao em='2000-01-01'><texto>é</texto></versao></dispositivo></lei>"
    for name, content in {"a b.xml": sound.encode(), "empty.xml": b"", "latin.xml": sound.encode("latin-1"), "cut.xml": sound.encode()[:30], "other.txt": b"x"}.items():
        (tmp_path / name).write_bytes(content)
    good, refused = files.xml_documents_checked(spark, str(tmp_path), "ro")
    assert {r.lei_id: r.ente for r in good.collect()} == {"a b": "ro", "cut": "ro"}
    assert {r.lei_id: r.reason for r in refused.collect()} == {"empty": "empty", "latin": "encoding"}
    unparsed = flatten.walked(good).where("error IS NOT NULL")
    assert files.batch_report(good, refused, unparsed).first().asDict() == {"total": 4, "converted": 1, "refused": 2, "unparsed": 1, "exit_code": 1}
    whole = good.where("lei_id = 'a b'")
    assert files.batch_report(whole, refused.limit(0), unparsed.limit(0)).first().exit_code == 0
    assert files.batch_report(whole.limit(0), refused.limit(0), unparsed.limit(0)).first().exit_code == 1
    with pytest.raises(FileNotFoundError):
        files.xml_documents_checked(spark, str(tmp_path / "other.txt"), "ro")


def test_exchange_documents(spark):
    v = lambda t: f"<versao><texto>old</texto></versao><versao><texto>{t}</texto></versao>"
    d = lambda p, *x: f"<dispositivo path='{p}'>{''.join(x)}</dispositivo>"
    article = d("art-1", v("one"), d("art-1-par-unico", v("sole"), d("art-1-par-unico-inc-2", v("x"))), d("art-1-inc-1", v("i"), d("art-1-inc-1-ali-c", v("c"), d("art-1-inc-1-ali-c-item-4", v("it")))), d("zz-9", v("lost"), d("art-9", v("lost"))))
    xml = f"<lei urn-lex='urn:x&quot;;1'>{d('titulo-lei', v('T'))}{d('tit-1', v('I'), d('tit-1-cap-2', v('II'), article, d('art-2', v('two'), '<revogacao/>')))}{d('disp-final-1', v('end'))}{d('anexo-1', v('a &lt; b'))}</lei>"
    got = {(r.lei_id, r.document): r.xml for r in exchange.documents(spark.createDataFrame([("l", xml), ("e", "<lei/>"), ("bad", "<lei>"), ("o", "<x/>"), ("n", None)], "lei_id string, xml string")).collect()}
    assert set(got) == {("l", ""), ("l", "anexo-1")}
    body = got["l", ""]
    assert 'URN="urn:x&quot;;1"' in body and "lost" not in body and '<ReferenciaAnexo AlvoURN="urn:x&quot;;1!anexo-1"/>' in body and "a &lt; b" in got["l", "anexo-1"]
    caput = '<Caput id="art1_cpt"><p>one</p><Inciso id="art1_cpt_inc1"><Rotulo>1</Rotulo><p>i</p><Alinea id="art1_cpt_inc1_ali3"><Rotulo>c)</Rotulo><p>c</p><Item id="art1_cpt_inc1_ali3_ite4"><Rotulo>4</Rotulo><p>it</p></Item></Alinea></Inciso></Caput>'
    assert f'<Artigo id="art1"><Rotulo>Art. 1</Rotulo>{caput}<Paragrafo id="art1_par1u"><Rotulo>Parágrafo único</Rotulo><p>sole</p><Inciso id="art1_par1u_inc2">' in body
    assert '<Artigo id="art2" situacao="revogado">' in body and '</Artigo></Capitulo></Titulo><Artigo id="art">' in body
    ids = {"tit-2-cap-1-sec-3-subsec-4": "tit2_cap1_sec3_sub4", "parte-1-liv-2": "prt1_liv2"}
    rows = spark.createDataFrame(list(ids), "string").toDF("p")
    assert {r.p: r.i for r in rows.select("p", exchange.group_id(F.col("p")).alias("i")).collect()} == ids


def test_outcomes_of_a_parse(spark):
    good = {"confidence": 0.5, "xml": "<lei><versao><fonte ia-id='r'/></versao></lei>", "tipo": "lei", "numero": " 7 ", "ano": "1990"}
    cases = {None: good, "answer": None, "confidence": good | {"confidence": "x"}, "document": good | {"xml": 3}, "provenance": good | {"xml": good["xml"].replace("'r'", "'other'")}, "fields": good | {"numero": None}, "number": good | {"numero": "²"}, "year": good | {"ano": "soon"}}
    for reason, answer in cases.items():
        got = parse.outcome(answer and json.dumps(answer), "r", "ro")
        assert got[0] == reason and (got[1] == "norma-ro-lei-00007-1990") == (reason is None)
    for bad in (None, "", "[]", '{"confidence": NaN}', '{"confidence": 0.49}'):
        assert parse.outcome(bad, "r", "ro")[0] in ("answer", "confidence")
    rows = spark.createDataFrame([("r", "ro", "text"), ("q", "ro", None)], "raw_id string, ente string, text string")
    found = parse.assembled(rows, lambda t: json.dumps(good) if t else "")
    assert {r.raw_id: (r.reason, r.lei_id) for r in found.collect()} == {"r": (None, "norma-ro-lei-00007-1990"), "q": ("answer", None)}
    record = parse.parsed_meta(found, "stand-in+ocr", "2024-01-01").first()
    assert json.loads(record.json)["fontes_consultadas"] == ["r"] and record.lei_id == "norma-ro-lei-00007-1990"


def test_digests_of_files_read_whole_or_as_streams(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.range(200_000).selectExpr("id", "uuid() AS u").repartition(2).write.parquet(path)
    files_ = sorted((tmp_path / "d").glob("*.parquet"))
    assert all(f.stat().st_size > 2 << 20 for f in files_)
    want = [(f.name, f.stat().st_size, hashlib.sha256(f.read_bytes()).hexdigest()) for f in files_]
    assert publish.file_digests(spark, path) == publish.file_digests(spark, path, whole=1 << 20) == want


def test_siblings_by_locale(spark):
    paths = ["art-2", "art-10", "art-1-a", "Art-1", "art-1", "árt-1"]
    rows = spark.createDataFrame([("l", None, 0, p) for p in paths] + [("l", None, None, "aaa"), ("l", "art-1", 1, "x")], "lei_id string, dispositivo_parent_path string, dispositivo_ordem int, dispositivo_path string")
    got = provisions.sibling_ranks(rows, "pt").where("dispositivo_parent_path IS NULL").orderBy("rank").collect()
    assert [r.dispositivo_path for r in got] == ["art-1", "Art-1", "árt-1", "art-1-a", "art-10", "art-2", "aaa"]


def test_lineage_ends_where_a_hop_is_missing(spark):
    index = spark.createDataFrame([("lei", "7", "", "pdf", "aaaa", "s1", 1), ("lei", "0007", "", "pdf", "bbbb", "s2", 2), ("lei", "7", "", "html", "cccc", "s3", 3), ("lei", "", "", "pdf", "dddd", "s4", 4)], "tipo string, numero string, rendicao string, formato string, uuid5 string, source string, seq long")
    raw = spark.createDataFrame([("raw-ro-p-lei-00007",), ("raw-ro-p-lei-00008",), ("raw-ro-p-coddoc-7",), ("other",), ("raw-xx-p-lei-7",), (None,), ("raw-ro-p-lei-99999999999999999999",)], "raw_id string")
    got = {r.raw_id: (r.hop, r.source, r.url and r.url.rpartition("download/")[2]) for r in captures.lineage(raw, index, "seq", ["ro"], suffix="_djvu.txt").collect()}
    assert got["raw-ro-p-lei-00007"] == ("found", "s2", "norma_ro_p_lei_0001-1000/lei-00007_bbbb_djvu.txt")
    assert {k: v[0] for k, v in got.items() if k != "raw-ro-p-lei-00007"} == {"raw-ro-p-lei-00008": "uncaptured", "raw-ro-p-coddoc-7": "unidentified", "other": "external", "raw-xx-p-lei-7": "external", None: "external", "raw-ro-p-lei-99999999999999999999": "unidentified"}
    assert got["other"][2] == "other/other_djvu.txt"
    one = captures.resolve(spark.createDataFrame([("ro", "p", "lei", 7)], "ente string, fonte string, tipo string, numero long"), index.withColumn("sha256", F.col("uuid5")), "seq", suffix="_djvu.txt").first()
    assert one.url.endswith("_djvu.txt")


def test_single_bad_rows_crash_nothing(spark):
    huge = "9" * 20
    docs = spark.createDataFrame([(1, f"Art. 1º x. Art. {huge} y. Art. 3000000000 z. Art. 3 w.")], "doc long, text string")
    found = {r.kind: list(r.numbers) for r in segmenter.structure(docs).collect()}
    assert found["missing_articles"] == [2] and "out_of_order" not in found
    assert [r.number for r in segmenter.segment(docs).orderBy("start").collect()] == [1, None, 3000000000, 3]
    assert [r.n for r in scoring.missing(spark.createDataFrame([(1, 1), (1, 3), (1, 3_000_000_000)], "doc long, n long")).collect()] == [2]
    one = spark.createDataFrame([(f"L{huge}.pdf", f"lei-{huge}")], "f string, k string")
    assert one.select(I.file_identity(F.col("f")).alias("a"), I.key_identity(F.col("k")).alias("b")).first()[:] == (None, None)
    index = spark.createDataFrame([("lei", huge), ("lei", "7"), ("lei", None)], "tipo string, numero string")
    assert [r.chave for r in captures.identities(index).collect()] == ["lei-00007"]
    urls = spark.createDataFrame([(f"u{huge}",), ("u5",)], "url string")
    assert generators.highest(urls, ["u{num}"]).first().numero == 5
    assert [search.valid_year(y) for y in ("²", "1990", "٢٠٠٠", "9" * 5000, "")] == [None, 1990, 2000, None, None]
