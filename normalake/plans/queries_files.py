"""Queries over files that sinks write and readers read again, and over more
shapes of what other modules ask for in one."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import functions as F

from normalake.functions import identity as I
from normalake.functions import law, text
from normalake.operators import provisions
from normalake.plans.base import query, table
from normalake.plans.norm_versions import norm_versions
from normalake.plans.queries_check import _COUNTS, _PAIRED, _R
from normalake.plans.queries_ledger import _L, index_rows, laws
from normalake.plans.queries_read import V
from normalake.plans.queries_text import _SEG, norm_texts
from normalake.schema import CAPTURES, EXPORT_COLUMNS, VERSIONS
from normalake.sources import files, generators, parse, publish
from normalake.sources.segmenter import against_gold, segmented
from normalake.sources.tables import stored, unique_folder
from normalake.streaming import captures as streams
from normalake.streaming import ledger

c = F.col


@query("src3_versions_json", V + "SELECT versao_id, em, ate, num_fontes, tem_divergencia, quality FROM versoes")
def _(spark, d):
    """JSON lines without a null column, read under the pinned schema."""
    where = unique_folder(spark, "json")
    publish.write_json(norm_versions(spark, d), where)
    return files.versions_json(spark, where).select("versao_id", "em", "ate", "num_fontes", "tem_divergencia", "quality")


@query("src7_capture_index", "SELECT event_type AS tipo, CASE WHEN user_id % 10 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS numero, '' AS rendicao, 'a \"b\", ' || (event_id % 7) AS source, count(*) AS n FROM events GROUP BY ALL")
def _(spark, d):
    """An index without one of its columns, with empty cells and quotes."""
    where = unique_folder(spark, "index")
    rows = index_rows(spark, d).withColumn("source", F.concat(F.lit('a "b", '), (c("event_id") % 7).cast("string"))).withColumn("numero", F.nullif("numero", F.lit("")))
    rows.select(*[x for x in CAPTURES.names if x != "rendicao"]).write.option("header", True).option("escape", '"').csv(where)
    return files.capture_index(spark, where).groupBy("tipo", "numero", "rendicao", "source").agg(F.count("*").alias("n"))


@query("src8_span_records", "SELECT CASE WHEN doc_id % 5 = 0 THEN 'test' ELSE 'val' END AS split, doc_id % 11 = 0 AS corrupt, count(*) AS n, sum(CASE WHEN doc_id % 11 = 0 THEN 0 ELSE 1 END) AS spans FROM documents GROUP BY 1, 2 UNION ALL SELECT 'train', NULL, 0, 0")
def _(spark, d):
    """Two splits, with blank and cut off lines; the third is not there."""
    where = unique_folder(spark, "spans")
    span = F.array(F.struct(F.lit("ementa").alias("category"), F.lit(0).alias("start"), F.lit(1).alias("end")))
    line = F.to_json(F.struct("text", span.alias("label"), F.create_map(F.lit("raw_id"), c("doc_id").cast("string")).alias("info")))
    rows = table(spark, d, "documents").select("doc_id", F.concat(F.when(c("doc_id") % 11 == 0, '{"text": "cut').otherwise(line), F.when(c("doc_id") % 3 == 0, "\n").otherwise("")).alias("value"))
    for name, of in (("test", c("doc_id") % 5 == 0), ("val", c("doc_id") % 5 != 0)):
        rows.where(of).select("value").write.text(f"{where}/{name}.jsonl")
    found, missing = files.span_splits(spark, where)
    counts = found.groupBy("split", c("_corrupt_record").isNotNull().alias("corrupt")).agg(F.count("*").alias("n"), F.sum(F.coalesce(F.size("label"), F.lit(0))).alias("spans"))
    return counts.union(spark.createDataFrame([(m, None, 0, 0) for m in missing], "split string, corrupt boolean, n long, spans long"))


@query("src10_label_space", "SELECT 'O' AS category UNION ALL SELECT DISTINCT event_type FROM events")
def _(spark, d):
    where = unique_folder(spark, "labels")
    names = table(spark, d, "events").agg(F.sort_array(F.collect_set("event_type")).alias("n"))
    names.select(F.to_json(F.struct(F.lit("v1").alias("category_version"), F.concat(F.array(F.lit("O")), "n").alias("span_class_names"))).alias("value")).write.text(where)
    return spark.createDataFrame([(x,) for x in files.label_space(spark, where)], "category string")


@query("snk1_write_versions", V + "SELECT tipo_lei, count(*) AS n, count(DISTINCT lei_id) AS leis FROM versoes GROUP BY 1")
def _(spark, d):
    where = unique_folder(spark, "versions")
    publish.write_versions(norm_versions(spark, d), where)
    return files.versions_parquet(spark, where).groupBy("tipo_lei").agg(F.count("*").alias("n"), F.countDistinct("lei_id").alias("leis"))


@query("snk2_export_laws", _L + "SELECT id, titulo, ano, ente FROM leis WHERE ente = 'NATION_3' AND ano = 1995")
def _(spark, d):
    return spark.read.parquet(publish.export_laws(laws(spark, d), unique_folder(spark, "laws"), "NATION_3", 1995)).select("id", "titulo", "ano", "ente")


@query("snk8_pool_files", "SELECT doc_id, length(text) AS n FROM documents WHERE length(text) >= 500 UNION ALL SELECT -1, count(*) FROM documents WHERE length(text) >= 500")
def _(spark, d):
    """A pool's lines, and in one more row the count taken as they were written."""
    where = unique_folder(spark, "pool")
    n = publish.write_pool(table(spark, d, "documents").where("length(text) >= 500").select("doc_id", "text"), where)
    back = spark.read.schema("doc_id long, text string").json(where)
    return back.select("doc_id", F.length("text").cast("bigint").alias("n")).union(back.select(F.lit(-1), F.lit(n)).limit(1))


_SIDECAR = "'\"ente\":\"ro\",\"fonte\":\"portal\",\"chave\":\"lei-' || page_id || '\",\"fonte_url\":' || to_json(url) || ',\"data_captura\":\"2024-02-29T00:00:00Z\",\"hash_{0}\":\"sha256:' || sha256(html) || '\",\"user_agent\":\"crawler\",\"id_bundle\":\"bundle-ro-portal-2024W09\",\"provenance_wayback\":{{\"fetched_from\":\"wayback\",\"wayback_url\":' || CASE WHEN page_id % 2 = 0 THEN '\"https://web.archive.org/web/20240101000000/x\",\"wayback_timestamp\":\"20240101000000\"' ELSE 'null,\"wayback_timestamp\":null' END || ',\"wayback_blocked_robots\":' || (page_id % 3 = 0) || '}}}}'"


@query("snk9_sidecars", f"SELECT 'lei-' || page_id AS chave, '{{\"meta_version\":\"0.1\",' || {_SIDECAR.format('pdf')} AS json FROM pages UNION ALL SELECT 'lei-' || page_id, '{{\"meta_version\":\"0.1\",\"content_type\":\"html\",' || {_SIDECAR.format('html')} FROM pages")
def _(spark, d):
    p = table(spark, d, "pages").select(F.lit("ro").alias("ente"), F.lit("portal").alias("fonte"), F.concat(F.lit("lei-"), "page_id").alias("chave"), c("url").alias("fonte_url"), c("html").alias("content"), F.lit("wayback").alias("fetched_from"), F.when(c("page_id") % 2 == 0, "https://web.archive.org/web/20240101000000/x").alias("wayback_url"), (c("page_id") % 3 == 0).alias("blocked"))
    day = F.lit("2024-02-29").cast("date")
    return publish.raw_sidecar(p, "2024-02-29T00:00:00Z", day, "crawler").union(publish.raw_sidecar(p, "2024-02-29T00:00:00Z", day, "crawler", html=True))


_DAYS = {f.name for f in VERSIONS if f.dataType.typeName() == "date"}
_FIELDS = ", ".join(f"'{x}', " + (f"strftime({x}, '%Y-%m-%d')" if x in _DAYS else x) for x in EXPORT_COLUMNS)


@query("snk13_export_json", V + f"SELECT CAST(json_object({_FIELDS}) AS VARCHAR) AS json FROM versoes WHERE ate IS NULL")
def _(spark, d):
    return publish.rows_json(norm_versions(spark, d).where("ate IS NULL"))


@query("snk14_export_csv", V + "SELECT versao_id, texto, fontes, strftime(em, '%Y-%m-%d') AS em, strftime(ate, '%Y-%m-%d') AS ate FROM versoes")
def _(spark, d):
    """Commas, quotes and nulls come back from the file as they were."""
    where = unique_folder(spark, "csv")
    publish.write_csv(norm_versions(spark, d), where, "gzip")
    return spark.read.option("header", True).option("escape", '"').option("lineSep", "\r\n").csv(where).select("versao_id", "texto", "fontes", "em", "ate")


@query("txt29_first_object", """SELECT o_orderkey AS id, CASE o_orderkey % 6 WHEN 4 THEN NULL WHEN 5 THEN NULL ELSE '{"a": ' || o_orderkey || '}' END AS json FROM orders""")
def _(spark, d):
    """An object alone, within prose, in a list, after a broken one; none."""
    one = F.concat(F.lit('{"a": '), c("o_orderkey").cast("string"), F.lit("}"))
    said = F.element_at(F.array(one, F.concat(F.lit("Sure: "), one, F.lit(" done {}")), F.concat(F.lit("["), one, F.lit("]")), F.concat(F.lit("{broken {"), one), F.lit("[1, 2]"), F.lit("nothing")), (c("o_orderkey") % 6 + 1).cast("int"))

    def run(frames):
        for frame in frames:
            got = [parse.first_object(t) for t in frame["said"]]
            yield pd.DataFrame({"id": frame["id"], "json": [None if g is None else json.dumps(g) for g in got]}, dtype=object)

    return table(spark, d, "orders").select(c("o_orderkey").alias("id"), said.alias("said")).mapInPandas(run, "id long, json string")


@query("str2_idempotent_runs", "SELECT user_id AS url, coalesce(min(event_id) FILTER (event_id % 5 < 2), min(event_id)) AS n FROM events GROUP BY 1")
def _(spark, d):
    """Three runs over files that arrive in between, the last one with nothing new."""
    where = unique_folder(spark, "ledger")
    e = table(spark, d, "events").select(c("user_id").alias("url"), c("event_id").alias("n"))
    for part in (e.where("n % 5 < 2"), e.where("n % 5 >= 2"), None):
        if part is not None:
            part.write.mode("append").parquet(f"{where}/in")
        stream = ledger.source(spark, f"{where}/in")
        ledger.upsert_batches(stream, f"{where}/out", "url", "n", f"{where}/state").awaitTermination()
    return ledger.ledger_rows(spark, f"{where}/out")


_FEDERAL = {"lei": ("lei", "l", "leis/L%d"), "lcp": ("lei", "lcp", "leis/lcp/Lcp%d"), "decreto": ("decreto", "d", "decreto/D%d"), "decreto-lei": ("decreto-lei", "del", "Decreto-Lei/Del%d"), "emc": ("Emenda", "emc", "Constituicao/Emendas/Emc/emc%02d"), "mpv": ("Mpv", "mpv", "MPV/Antigas_2001/%d")}
_YEAR = "CAST(year(o_orderdate) + 8 AS INT)"


@query("src16_federal_kinds", " UNION ALL ".join(f"SELECT '{k}' AS kind, o_orderkey AS num, CASE WHEN {_YEAR} >= 2003 THEN printf('https://f.example/_ato%d-%d/%d/{f}/{h}%d.htm', 2003 + (({_YEAR} - 2003) // 4) * 4, 2006 + (({_YEAR} - 2003) // 4) * 4, {_YEAR}, o_orderkey) ELSE printf('https://f.example/{old}.htm', o_orderkey) END AS url FROM orders" for k, (f, h, old) in _FEDERAL.items()))
def _(spark, d):
    o = table(spark, d, "orders").select(c("o_orderkey").alias("num"), F.expr(_YEAR).alias("year"))
    return generators.federal_kinds(o.select("num"), o, "https://f.example/", list(generators.FEDERAL_KINDS)).select("kind", "num", "url")


@query("flt12_folded_current", V + "SELECT lei_id, dispositivo_path, versao_id FROM (SELECT *, row_number() OVER (PARTITION BY lei_id, dispositivo_path ORDER BY ate IS NULL DESC, coalesce(epoch_ms(CAST(em AS TIMESTAMP)), 0) DESC, versao_id DESC) AS rn FROM versoes) WHERE rn = 1 AND contains(strip_accents(lower(texto)), 'dispositivo art-1-par')")
def _(spark, d):
    """Without accents and case, over current wordings only."""
    now = provisions.current(norm_versions(spark, d))
    return now.where(text.contains_folded(c("texto"), "Dispositívo ÁRT-1-par")).select("lei_id", "dispositivo_path", "versao_id")


@query("txt9_longest_slug", """WITH r AS (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'raw-ro-portal-lei-' || c_custkey WHEN 1 THEN 'raw-ro-norte-casa-lei-7' WHEN 2 THEN 'raw-ro-norte' WHEN 3 THEN 'other-ro-portal-x' ELSE 'raw-sp--x' END AS raw_id FROM customer)
SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'ro' WHEN 1 THEN 'ro-norte' WHEN 2 THEN NULL END AS ente, CASE c_custkey % 5 WHEN 0 THEN 'portal' WHEN 1 THEN 'casa' END AS fonte, CASE c_custkey % 5 WHEN 0 THEN 'lei-' || c_custkey WHEN 1 THEN 'lei-7' END AS chave FROM r""")
def _(spark, d):
    """The longest slug decides; what does not have all parts has none."""
    k = c("c_custkey").cast("string")
    raw = F.element_at(F.array(F.concat(F.lit("raw-ro-portal-lei-"), k), F.lit("raw-ro-norte-casa-lei-7"), F.lit("raw-ro-norte"), F.lit("other-ro-portal-x"), F.lit("raw-sp--x")), (c("c_custkey") % 5 + 1).cast("int"))
    return table(spark, d, "customer").select("c_custkey", I.raw_id_parts(raw, ["ro", "ro-norte", "sp"]).alias("p")).select("c_custkey", "p.*")


_ROMAN = "(VALUES (1, 'I'), (2, 'II'), (3, 'III'), (4, 'IV'), (5, 'V'), (6, 'VI'), (7, 'VII'), (8, 'VIII'), (9, 'IX'), (10, 'X'), (11, 'XI'), (12, 'XII')) r(n, roman)"


@query("law14_deep_breadcrumbs", f"""WITH k AS (SELECT p_partkey, p_partkey % 12 + 1 AS n FROM part)
SELECT p_partkey, 'tit-' || n || '-cap-' || n AS grupo, 'Título ' || roman || ' › Capítulo ' || roman AS trilha_grupo, 'art-' || (n + 8) || '-par-' || n || '-inc-' || n || '-ali-b-item-' || n AS path, 'item-' || n AS ultimo,
  'Art. ' || (n + 8) || CASE WHEN n + 8 < 10 THEN 'º' ELSE '' END || ' › § ' || n || CASE WHEN n < 10 THEN 'º' ELSE '' END || ' › ' || roman || ' › b) › item ' || n AS trilha FROM k JOIN {_ROMAN} USING (n)""")
def _(spark, d):
    """Paths of five levels, and of groups."""
    n = (c("p_partkey") % 12 + 1).cast("string")
    p = table(spark, d, "part").select("p_partkey", F.concat(F.lit("tit-"), n, F.lit("-cap-"), n).alias("grupo"), F.concat(F.lit("art-"), (c("p_partkey") % 12 + 9).cast("string"), F.lit("-par-"), n, F.lit("-inc-"), n, F.lit("-ali-b-item-"), n).alias("path"))
    return p.select("p_partkey", "grupo", law.breadcrumb(c("grupo")).alias("trilha_grupo"), "path", F.element_at(law.segments(c("path")), -1).alias("ultimo"), law.breadcrumb(c("path")).alias("trilha"))


#: Gold that differs from what the segmenter finds: shifted ends, spans that are not there, spans left out.
_OFF = _SEG.replace("WITH ", "WITH RECURSIVE ", 1).replace("p AS (", "pieces AS (", 1).replace("FROM p)", "FROM pieces)") + """, t AS (SELECT * FROM s WHERE category IN ('art_marcador', 'ementa', 'vigencia')),
g AS (SELECT doc, category, "start", CASE WHEN doc % 4 = 1 AND category = 'ementa' THEN "end" - 3 ELSE "end" END AS "end" FROM t WHERE NOT (doc % 4 = 2 AND category = 'art_marcador')
  UNION ALL SELECT o_orderkey, 'vigencia', 0, 2 FROM orders WHERE o_orderkey % 4 = 3),
p AS (SELECT doc, category, "start", "end" FROM t) """


def _off_gold(spark, d):
    """doc, label, found: texts are segmented once, for what is found and for
    the gold that is made from it."""
    rows = segmented(norm_texts(spark, d), {"art_marcador", "ementa", "vigencia"})
    end = lambda s: F.when((c("doc") % 4 == 1) & (s["category"] == "ementa"), s["end"] - 3).otherwise(s["end"])
    kept = F.filter("found", lambda s: ~((c("doc") % 4 == 2) & (s["category"] == "art_marcador")))
    span = lambda category, start, end: F.struct(category.alias("category"), start.alias("start"), end.alias("end"))
    more = F.array(span(F.lit("vigencia"), F.lit(0).cast("long"), F.lit(2).cast("long")))
    label = F.transform(kept, lambda s: span(s["category"], s["start"], end(s)))
    return rows.withColumn("label", F.when(c("doc") % 4 == 3, F.concat(label, more)).otherwise(label))


@query("seg12_all_metrics", _OFF + _COUNTS + f""", a AS (SELECT * FROM n UNION ALL SELECT 'MICRO', sum(gold), sum(pred), sum(exact_tp), sum(overlap_tp_pred), sum(overlap_tp_gold) FROM n),
m AS (SELECT *, {_R('exact_tp', 'pred')} AS exact_p, {_R('exact_tp', 'gold')} AS exact_r, {_R('overlap_tp_pred', 'pred')} AS overlap_p, {_R('overlap_tp_gold', 'gold')} AS overlap_r FROM a)
SELECT category, CAST(gold AS BIGINT) AS gold, CAST(pred AS BIGINT) AS pred, CAST(exact_tp AS BIGINT) AS exact_tp, CAST(overlap_tp_pred AS BIGINT) AS overlap_tp_pred, CAST(overlap_tp_gold AS BIGINT) AS overlap_tp_gold,
  exact_p, exact_r, {_R('2 * exact_p * exact_r', '(exact_p + exact_r)')} AS exact_f1, overlap_p, overlap_r, {_R('2 * overlap_p * overlap_r', '(overlap_p + overlap_r)')} AS overlap_f1 FROM m""")
def _(spark, d):
    """Exact and overlap figures, with precision and recall below 1."""
    return against_gold(_off_gold(spark, d))[0]


@query("seg13_all_errors", _OFF + _PAIRED + "SELECT kind, category, count(*) AS n FROM e GROUP BY 1, 2")
def _(spark, d):
    """Boundary errors, missed and spurious spans."""
    return against_gold(_off_gold(spark, d))[1].groupBy("kind", "category").agg(F.count("*").alias("n"))
