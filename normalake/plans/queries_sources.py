"""Queries over files that are written from the tables and read again, and
over what the parse and export stages make."""

from __future__ import annotations

import json
import re

from pyspark.sql import functions as F

from normalake.operators import provisions
from normalake.plans.base import query, table
from normalake.plans.queries_documents import _LEI, _URN, numbered_documents
from normalake.sources import annotation, exchange, files, flatten, listings, parse, publish
from normalake.sources.tables import unique_folder

c = F.col


def _listing_files(spark, d):
    """Five listing files, one in another order of columns and without one."""
    name = "CASE page_id % 3 WHEN 0 THEN concat('L', page_id, '.pdf') WHEN 1 THEN concat('oficio-', page_id, '.PDF') ELSE concat('p', page_id, '.html') END"
    p = table(spark, d, "pages").selectExpr("page_id", "page_id % 5 AS k", f"concat(CASE WHEN page_id % 2 = 0 THEN 'http' ELSE 'https' END, '://a.example/docs/', {name}) AS original", "CASE WHEN page_id % 7 = 0 THEN '404' ELSE '200' END AS statuscode", "concat('2024010100', lpad(page_id % 10000, 4, '0')) AS timestamp")
    usual, other = ["urlkey", "timestamp", "original", "mimetype", "statuscode", "digest", "length"], ["statuscode", "original", "timestamp", "urlkey"]
    value = {"urlkey": F.lit("example,a)/docs"), "mimetype": F.lit("application/pdf"), "digest": F.lit("D"), "length": F.lit("1")}
    line = lambda names: F.to_json(F.array(*[value.get(n, c(n)) for n in names]))
    rows = p.select("k", F.concat(F.when(c("k") == 4, line(other)).otherwise(line(usual)), F.lit(",")).alias("value"))
    heads = p.select("k").distinct().select("k", F.concat(F.lit("["), F.when(c("k") == 4, json.dumps(other)).otherwise(json.dumps(usual)), F.lit(",")).alias("value"))
    where = unique_folder(spark, "listing")
    heads.union(rows).union(heads.select("k", F.lit("]"))).repartition("k").sortWithinPartitions("k", F.desc("value")).write.partitionBy("k").text(where)
    return where


_ORIGINAL = "CASE WHEN page_id % 2 = 0 THEN 'http' ELSE 'https' END || '://a.example/docs/' || CASE page_id % 3 WHEN 0 THEN 'L' || page_id || '.pdf' WHEN 1 THEN 'oficio-' || page_id || '.PDF' ELSE 'p' || page_id || '.html' END"
_LISTED = f"SELECT page_id, {_ORIGINAL} AS original, CASE WHEN page_id % 7 = 0 THEN '404' ELSE '200' END AS statuscode, '2024010100' || lpad(CAST(page_id % 10000 AS VARCHAR), 4, '0') AS timestamp FROM pages"


@query("src12_listing_files", f"SELECT timestamp, original, statuscode, CASE WHEN page_id % 5 <> 4 THEN 'application/pdf' END AS mimetype FROM ({_LISTED})")
def _(spark, d):
    return listings.archive_listing(spark, _listing_files(spark, d)).select("timestamp", "original", "statuscode", "mimetype")


@query("udf1_discovery_by_name", f"""SELECT 'https://' || regexp_replace(original, '^https?://', '') AS url, 'ro' AS ente, 'portal' AS fonte, CASE WHEN page_id % 3 = 0 THEN 'lei' ELSE '' END AS tipo_documento,
  CASE WHEN page_id % 3 = 0 THEN 'lei-' || printf('%05d', page_id) ELSE 'documento-oficio-' || page_id END AS chave, 'pending' AS status, 'https://web.archive.org/web/' || timestamp || '/' || original AS wayback_snapshot
FROM ({_LISTED}) WHERE statuscode = '200' AND page_id % 3 < 2
UNION ALL SELECT 'https://a.example/docs/L' || n || '.pdf', 'ro', 'portal', 'lei', 'lei-' || printf('%05d', n), 'pending', NULL FROM range(1, 41) r(n)""")
def _(spark, d):
    """A source's strategies by name; one whose files are not there is left out."""
    entries = [{"strategy": "wayback-cdx", "path": _listing_files(spark, d), "prefix": "https://a.example/docs/"}, {"strategy": "sequential", "template": "https://a.example/docs/L{num}.pdf", "start": 1, "end": 40}, {"strategy": "wayback-cdx", "path": unique_folder(spark, "none"), "prefix": "https://"}]
    found, failed = listings.discover(spark, entries, "ro", "portal")
    if list(failed) != ["wayback-cdx"]:
        raise ValueError(failed)
    return found


@query("src9_manifest", """SELECT r_name AS ente, n_name AS fonte, CASE WHEN n_nationkey % 2 = 0 THEN 'pdf' ELSE 'html' END AS tipo_ingestion, CASE WHEN n_nationkey % 3 = 0 THEN 'https://a.example/' || n_nationkey END AS probe, p AS place,
  CASE p WHEN 0 THEN 'sequential' ELSE 'wayback-cdx' END AS strategy, CASE p WHEN 0 THEN n_nationkey END AS first FROM nation JOIN region ON n_regionkey = r_regionkey, (VALUES (0), (1)) x(p)""")
def _(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), c("n_regionkey") == c("r_regionkey"))
    first = F.to_json(F.struct(F.lit("sequential").alias("strategy"), c("n_nationkey").alias("start"), F.lit(9).alias("end")))
    body = F.concat(F.lit('{"tipo_ingestion": "'), F.when(c("n_nationkey") % 2 == 0, "pdf").otherwise("html"), F.lit('", '), F.when(c("n_nationkey") % 3 == 0, F.concat(F.lit('"probe": "https://a.example/'), "n_nationkey", F.lit('", '))).otherwise(""), F.lit('"discovery": ['), first, F.lit(', {"strategy": "wayback-cdx", "prefix": "http://x"}]}'))
    each = n.groupBy("r_name").agg(F.array_join(F.collect_list(F.concat(F.lit('"'), "n_name", F.lit('": '), body)), ",\n").alias("f"))
    where = unique_folder(spark, "manifests")
    each.select("r_name", F.concat(F.lit('{"ente": "'), "r_name", F.lit('",\n "fontes": {'), "f", F.lit("}}")).alias("value")).repartition("r_name").write.partitionBy("r_name").text(where)
    return listings.manifest(spark, where).select("ente", "fonte", "tipo_ingestion", "probe", "place", "strategy", F.get_json_object("config", "$.start").cast("bigint").alias("first"))


_BAD = "CASE WHEN k % 50 = 0 THEN 'unparsed' WHEN k % 50 = 2 THEN 'empty' WHEN k % 50 = 3 THEN 'encoding' WHEN k % 50 = 4 THEN 'unparsed' WHEN k % 50 = 5 THEN 'unread' END"


def _raw_files(spark, d):
    """lei_id, ente, content; some empty, cut off, in another encoding, unread."""
    k = c("k") % 50
    raw = c("xml").cast("binary")
    content = F.when(k == 2, F.lit(b"")).when(k == 3, F.concat(raw, F.lit(b"\xe9\xff"))).when(k == 4, F.expr("substring(CAST(xml AS BINARY), 1, 40)")).when(k == 5, F.lit(None).cast("binary")).otherwise(raw)
    return numbered_documents(spark, d).select("lei_id", "ente", content.alias("content"))


@query("src4_checked_documents", f"""WITH n AS (SELECT DISTINCT l_partkey AS k FROM lineitem), i AS (SELECT {_LEI} AS lei_id, {_BAD} AS reason FROM n) SELECT * FROM i WHERE reason IS NOT NULL""")
def _(spark, d):
    sound, refused = files.checked(_raw_files(spark, d))
    return refused.union(flatten.unparsed(sound).select("lei_id", F.lit("unparsed")))


@query("src4_batch_report", f"""WITH n AS (SELECT DISTINCT l_partkey AS k FROM lineitem), i AS (SELECT {_BAD} AS reason FROM n), t AS (SELECT count(*) AS total, count(*) FILTER (reason <> 'unparsed') AS refused, count(*) FILTER (reason = 'unparsed') AS unparsed FROM i)
SELECT total, total - refused - unparsed AS converted, refused, unparsed, CAST(CASE WHEN refused > 0 THEN 1 ELSE 0 END AS INT) AS exit_code FROM t""")
def _(spark, d):
    sound, refused = files.checked(_raw_files(spark, d))
    return files.batch_report(sound, refused, flatten.unparsed(sound))


_FINDS = "('a', substr(text, 4, 2), 1), ('b', substr(text, 4, 2), 3), ('c', substr(text, 4, 2), 6), ('d', substr(text, 10, 1), 4), ('e', 'zz~zz', 1)"


@query("seg16_from_spans", f"""WITH RECURSIVE f AS (SELECT doc_id AS doc, text, unnest([{{'category': 'a', 'm': substr(text, 4, 2), 'nth': 1}}, {{'category': 'b', 'm': substr(text, 4, 2), 'nth': 3}}, {{'category': 'c', 'm': substr(text, 4, 2), 'nth': 6}}, {{'category': 'd', 'm': substr(text, 10, 1), 'nth': 4}}, {{'category': 'e', 'm': 'zz~zz', 'nth': 1}}], recursive := true) FROM documents),
r AS (SELECT doc, category, text, m, nth, 1 AS k, CASE WHEN m = '' THEN 0 ELSE strpos(text, m) END AS p FROM f
  UNION ALL SELECT doc, category, text, m, nth, k + 1, CASE WHEN strpos(substr(text, p + 1), m) = 0 THEN 0 ELSE p + strpos(substr(text, p + 1), m) END FROM r WHERE p > 0 AND k < nth)
SELECT doc, category, CAST(p - 1 AS BIGINT) AS "start", CAST(p - 1 + length(m) AS BIGINT) AS "end" FROM r WHERE k = nth AND p > 0
UNION ALL SELECT doc_id, 'given', 0, 3 FROM documents WHERE text IS NOT NULL
UNION ALL SELECT doc, category, NULL, NULL FROM f WHERE text IS NOT NULL AND NOT EXISTS (SELECT 1 FROM r WHERE r.doc = f.doc AND r.category = f.category AND r.k = r.nth AND r.p > 0)""")
def _(spark, d):
    """Repeated and overlapping needles; those that are not there as rows of their own."""
    find = lambda k, m, n: f"named_struct('category', '{k}', 'match', {m}, 'nth', {n}L)"
    finds = ", ".join([find("a", "substring(text, 4, 2)", 1), find("b", "substring(text, 4, 2)", 3), find("c", "substring(text, 4, 2)", 6), find("d", "substring(text, 10, 1)", 4), find("e", "'zz~zz'", 1)])
    records = table(spark, d, "documents").selectExpr("doc_id AS doc", "text", "array(named_struct('category', 'given', 'start', 0L, 'end', 3L)) AS spans", f"array({finds}) AS finds")
    found, lost = annotation.from_spans(records)
    none = F.lit(None).cast("bigint")
    return found.select("doc", F.explode("label").alias("s")).select("doc", "s.category", "s.start", "s.end").union(lost.select("doc", "category", none, none))


_POOL = "WITH n AS (SELECT doc_id AS raw_id, lang AS ente, source AS fonte, text, row_number() OVER (PARTITION BY concat_ws('/', lang, source) ORDER BY md5(doc_id || ':42'), doc_id) AS rn FROM documents) "


@query("seg15_annotation_pool", _POOL + "SELECT raw_id, ente, fonte, md5(text) AS text, 0 AS labels FROM n WHERE rn <= 9 AND length(text) >= 200")
def _(spark, d):
    rows = table(spark, d, "documents").selectExpr("doc_id AS raw_id", "lang AS ente", "source AS fonte", "text")
    return annotation.annotation_pool(rows, 5, floor=9, cap=40)[0].select("info.*", F.md5("text").alias("text"), F.size("label").alias("labels"))


@query("seg15_pool_manifest", _POOL + "SELECT ente, fonte, count(*) AS available, count(*) FILTER (rn <= 9) AS picked, count(*) FILTER (rn <= 9 AND length(text) >= 200) AS kept, count(*) FILTER (rn <= 9 AND (text IS NULL OR length(text) < 200)) AS skipped FROM n GROUP BY 1, 2")
def _(spark, d):
    rows = table(spark, d, "documents").selectExpr("doc_id AS raw_id", "lang AS ente", "source AS fonte", "text")
    return annotation.annotation_pool(rows, 5, floor=9, cap=40)[1]


_T = lambda n: f"coalesce(max(body) FILTER (ln = {n}), '')"
_GONE = lambda n: f"CASE WHEN (k + {n}) % 13 IN (0, 1) THEN ' situacao=\"revogado\"' ELSE '' END"


@query("snk15_exchange_annexes", f"""WITH b AS (SELECT l_partkey AS k, l_linenumber AS ln, CAST(l_shipdate AS DATE) AS dia, min(l_orderkey) AS src FROM lineitem GROUP BY 1, 2, 3),
v AS (SELECT *, row_number() OVER (PARTITION BY k, ln ORDER BY dia) AS i FROM b),
l AS (SELECT k, ln, arg_max(CASE WHEN src % 13 = 0 THEN '' ELSE 'Linha ' || ln || ' &amp;  é ' || src END, i) AS body FROM v GROUP BY 1, 2),
n AS (SELECT k, {_LEI} AS lei_id, coalesce({_URN}, '{exchange.FALLBACK_URN}') AS urn, {', '.join(f'{_T(i)} AS t{i}' for i in range(1, 8))} FROM l WHERE k % 50 > 1 GROUP BY k)
SELECT lei_id, '' AS document, '<LexML><Metadado><Identificacao URN="' || urn || '"/></Metadado><Norma><ParteInicial><Ementa id="ementa1">' || t1 || '</Ementa></ParteInicial><Articulacao><Artigo id="art1"' || {_GONE(2)} || '><Rotulo>Art. 1</Rotulo><Caput id="art1_cpt"><p>' || t2
  || '</p></Caput><Paragrafo id="art1_par1"' || {_GONE(3)} || '><Rotulo>§ 1</Rotulo><p>' || t3 || '</p></Paragrafo><Paragrafo id="art1_par2"' || {_GONE(4)} || '><Rotulo>§ 2</Rotulo><p>' || t4 || '</p></Paragrafo></Artigo><Artigo id="art2"' || {_GONE(5)} || '><Rotulo>Art. 2</Rotulo><Caput id="art2_cpt"><p>' || t5
  || '</p><Inciso id="art2_cpt_inc1"><Rotulo>1</Rotulo><p>' || t6 || '</p><Alinea id="art2_cpt_inc1_ali1"><Rotulo>a)</Rotulo><p>' || t7 || '</p></Alinea></Inciso></Caput></Artigo></Articulacao>'
  || CASE WHEN k % 2 = 0 THEN '<Anexos><ReferenciaAnexo AlvoURN="' || urn || '!anexo-1"/><ReferenciaAnexo AlvoURN="' || urn || '!anexo-2"/></Anexos>' ELSE '' END || '</Norma></LexML>' AS xml FROM n
UNION ALL SELECT lei_id, 'anexo-' || a, '<LexML><Metadado><Identificacao URN="' || urn || '!anexo-' || a || '"/></Metadado><Anexo><DocumentoGenerico id="doc-anexo-' || a || '"><PartePrincipal id="pp-anexo-' || a || '"><p id="p-anexo-' || a || '">' || CASE a WHEN 1 THEN 'Tabela &lt;1&gt;' ELSE '' END || '</p></PartePrincipal></DocumentoGenerico></Anexo></LexML>' FROM n, (VALUES (1), (2)) x(a) WHERE k % 2 = 0""")  # fmt: skip
def _(spark, d):
    """Norms with and without annexes, the last wording by document order."""
    more = '<dispositivo path="anexo-1"><versao><texto>velho</texto></versao><versao><texto>Tabela &lt;1&gt;</texto></versao></dispositivo><dispositivo path="anexo-2"/></lei>'
    docs = numbered_documents(spark, d).withColumn("xml", F.when(c("k") % 2 == 0, F.replace("xml", F.lit("</lei>"), F.lit(more))).otherwise(F.col("xml")))
    return exchange.documents(docs)


_PATHS = ("art-10", "art-2", "art-1-a", "art-1", "Art-1", "árt-1", "art-1-par-unico", "ârt-2")


@query("srt6_locale_order", f"""WITH p AS (SELECT s_nationkey AS lei_id, CAST([{', '.join(map(repr, _PATHS))}][s_suppkey % 8 + 1] AS VARCHAR) || CASE WHEN s_suppkey % 3 = 0 THEN '-b' ELSE '' END AS path FROM supplier)
SELECT lei_id, path, row_number() OVER (PARTITION BY lei_id ORDER BY path COLLATE pt, path) AS place FROM (SELECT DISTINCT * FROM p)""")
def _(spark, d):
    rows = table(spark, d, "supplier").select(c("s_nationkey").alias("lei_id"), F.concat(F.element_at(F.array(*map(F.lit, _PATHS)), (c("s_suppkey") % 8 + 1).cast("int")), F.when(c("s_suppkey") % 3 == 0, "-b").otherwise("")).alias("dispositivo_path")).distinct()
    ranked = provisions.sibling_ranks(rows.withColumn("dispositivo_parent_path", F.lit(None).cast("string")).withColumn("dispositivo_ordem", F.lit(0)), "pt")
    return ranked.select("lei_id", c("dispositivo_path").alias("path"), c("rank").alias("place"))


def _stand_in(text: str) -> str:
    """What a model might say of "order N of PRIORITY on YEAR"."""
    k, about, year = re.match(r"order (\d+) of (.*) on (\d+)", text).groups()
    raw = f"raw-ro-portal-lei-{k}"
    source = f'<fonte ia-id="{raw if int(k) % 8 != 5 else "raw-ro-portal-lei-0"}"/>' * (2 if int(k) % 8 == 4 else 1)
    xml = f'<lei><dispositivo path="art-1"><versao em="{year}-01-02"><texto>{about} &amp; {k}</texto>{source}</versao></dispositivo></lei>'
    answer = {"confidence": 0.2 if int(k) % 8 == 2 else "0.9", "xml": xml[:-3] if int(k) % 8 == 3 else xml, "tipo": None if int(k) % 8 == 6 else "lei", "numero": f"{k}a" if int(k) % 8 == 7 else int(k), "ano": year}
    return "I see no law." if int(k) % 8 == 1 else f"Here it is: {json.dumps(answer)} Anything else?"


@query("udf3_parse_assembly", """WITH o AS (SELECT o_orderkey AS k, o_orderpriority AS about, year(o_orderdate) AS y FROM orders)
SELECT 'raw-ro-portal-lei-' || k AS raw_id, CASE k % 8 WHEN 1 THEN 'answer' WHEN 2 THEN 'confidence' WHEN 3 THEN 'document' WHEN 4 THEN 'provenance' WHEN 5 THEN 'provenance' WHEN 6 THEN 'fields' WHEN 7 THEN 'number' END AS reason,
  CASE WHEN k % 8 = 0 THEN 'norma-ro-lei-' || printf('%05d', k) || '-' || y || '#art-1#' || y || '-01-02' END AS versao_id, CASE WHEN k % 8 = 0 THEN about || ' & ' || k END AS texto FROM o""")
def _(spark, d):
    """From answers to versions, or to the reason why there is none."""
    rows = table(spark, d, "orders").select(F.concat(F.lit("raw-ro-portal-lei-"), "o_orderkey").alias("raw_id"), F.lit("ro").alias("ente"), F.concat(F.lit("order "), "o_orderkey", F.lit(" of "), "o_orderpriority", F.lit(" on "), F.year("o_orderdate")).alias("text"))
    found = parse.assembled(rows, _stand_in)
    none = F.lit(None).cast("string")
    versions = flatten.flatten(found.where("reason IS NULL").select("lei_id", "ente", "xml"))
    raw = F.element_at(F.from_json("fontes", "array<struct<ia_id: string>>"), 1)["ia_id"]
    return versions.select(raw.alias("raw_id"), none.alias("reason"), "versao_id", "texto").union(found.where("reason IS NOT NULL").select("raw_id", "reason", none, none))


@query("snk10_dataset_digest", "SELECT count(*) AS row_count, true AS same FROM supplier")
def _(spark, d):
    """A dataset's record is the same whether files are digested whole or as streams."""
    where = unique_folder(spark, "dataset")
    table(spark, d, "supplier").repartition(3).write.parquet(where)
    one, other = (json.loads(publish.dataset_meta(spark, where, "1", "2024-01-01", whole=w)) for w in (1 << 28, 0))
    return spark.read.parquet(where).agg(F.count("*").alias("row_count"), F.lit(one == other and one["row_count"] > 0).alias("same"))
