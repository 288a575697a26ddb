"""Queries for the remaining projections, filters, joins and functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from normalake.functions import identity as I
from normalake.functions import law
from normalake.operators import captures, scoring, search
from normalake.plans.base import query, table
from normalake.plans.norm_versions import CTE, norm_versions
from normalake.plans.queries_check import _S, _spans
from normalake.plans.queries_ledger import index_rows
from normalake.sources import files, flatten, publish

c = F.col
V = f"WITH {CTE} "


@query("prj1_select_all", "SELECT * FROM nation")
def _(spark, d):
    return table(spark, d, "nation").select("*")


@query("prj4_casts", "SELECT CAST(l_quantity AS BIGINT) AS n, CAST(l_linenumber AS INT) AS i, l_orderkey FROM lineitem")
def _(spark, d):
    return table(spark, d, "lineitem").select(c("l_quantity").cast("bigint").alias("n"), c("l_linenumber").cast("int").alias("i"), "l_orderkey")


@query("prj11_harvest_record", "SELECT 'ro_' || c_custkey AS id, upper(c_mktsegment) AS titulo, list_last(string_split('lei-' || c_custkey, '-')) AS numero FROM customer")
def _(spark, d):
    k = c("c_custkey").cast("string")
    return table(spark, d, "customer").select(F.concat(F.lit("ro_"), k).alias("id"), F.upper("c_mktsegment").alias("titulo"), I.last_segment(F.concat(F.lit("lei-"), k)).alias("numero"))


@query("flt15_magic_bytes", "SELECT page_id FROM pages WHERE page_id % 3 = 0")
def _(spark, d):
    """Downloads of which every third is a PDF, by its first bytes."""
    content = F.when(c("page_id") % 3 == 0, F.concat(F.lit("%PDF-1.7"), "html")).when(c("page_id") % 3 == 1, F.concat(F.lit(" %PDF"), "html")).otherwise(c("html")).cast("binary")
    return table(spark, d, "pages").where(files.is_pdf(content)).select("page_id")


@query("flt21_robots_allowed", """WITH u AS (SELECT DISTINCT url, nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)', 1), '') AS host, coalesce(nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^#]*)', 1), ''), '/') AS path FROM pages WHERE url IS NOT NULL)
SELECT url, host IS NOT NULL AND CASE length(host) % 3 WHEN 0 THEN starts_with(path, '/en/7') OR NOT starts_with(path, '/en/') WHEN 1 THEN NOT starts_with(path, '/es/') ELSE true END AS allowed FROM u""")
def _(spark, d):
    """Hosts with rules of the agent's own, for all agents, and without any."""
    pages = table(spark, d, "pages").where("url IS NOT NULL")
    hosts = pages.select(F.regexp_extract("url", "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1).alias("host")).distinct()
    own = "# rules\nUser-agent: *\nDisallow: /\n\nUser-Agent: other\nUser-agent: Norma-Crawler\nAllow: /en/7\nDisallow: /en/ # but one\n"
    robots = hosts.select("host", F.when(F.length("host") % 3 == 0, F.lit(own)).when(F.length("host") % 3 == 1, F.lit("User-agent: *\r\nDisallow: /es/\r\nAllow: /\r\n")).otherwise(F.lit("User-agent: *\nDisallow:\n")).alias("text"))
    return files.robots_allowed(pages, robots, "norma-crawler")


@query("flt22_valid_year", V + "SELECT '1997' AS entrada, count(*) AS n FROM versoes WHERE ate IS NULL AND year(em) = 1997 UNION ALL SELECT i, count(*) FROM versoes, (VALUES ('1850'), ('x'), ('')) v(i) WHERE ate IS NULL GROUP BY 1")
def _(spark, d):
    """A year that is none filters nothing."""
    v = norm_versions(spark, d)
    each = [v.where(search.predicates(year=search.valid_year(y))).agg(F.count("*").alias("n")).select(F.lit(y).alias("entrada"), "n") for y in ("1997", "1850", "x", "")]
    return reduce(lambda a, b: a.union(b), each)


@query("jn5_overlapping_spans", _S + 'SELECT doc, category, "start", "end" FROM g WHERE EXISTS (SELECT 1 FROM p WHERE g.doc = p.doc AND g.category = p.category AND g."start" < p."end" AND p."start" < g."end")')
def _(spark, d):
    g, p = _spans(spark, d)
    return scoring._overlapping(g, p)


@query("jn6_exact_spans", _S + 'SELECT doc, category, "start", "end" FROM p WHERE EXISTS (SELECT 1 FROM g WHERE g.doc = p.doc AND g.category = p.category AND g."start" = p."start" AND g."end" = p."end")')
def _(spark, d):
    g, p = _spans(spark, d)
    return p.join(g.distinct(), scoring.SPAN, "left_semi")


@query("txt9_raw_ids", "SELECT c_custkey, 'ro' AS ente, 'portal' AS fonte, 'lei-' || c_custkey AS chave FROM customer")
def _(spark, d):
    raw = F.concat(F.lit("raw-ro-portal-lei-"), c("c_custkey").cast("string"))
    return table(spark, d, "customer").select("c_custkey", I.raw_id_parts(raw, ["ro", "rr"]).alias("p")).select("c_custkey", "p.*")


@query("txt12_content_hash", "SELECT doc_id, sha256(text) AS sha FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))


#: The UUID's name space of host names, as bytes, before the digest.
@query("txt12_content_name", "SELECT doc_id, substr(sha1(from_hex('6ba7b8109dad11d180b400c04fd430c8') || encode(sha256(text))), 1, 8) AS nome FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", I.content_name(F.sha2("text", 256)).alias("nome"))


@query("txt20_safe_path", "SELECT DISTINCT regexp_replace(lower(p_name), '[^a-z0-9-]', '_', 'g') AS nome FROM part")
def _(spark, d):
    return table(spark, d, "part").select(I.safe_path(F.lower("p_name")).alias("nome")).distinct()


@query("law16_evidence_urls", "SELECT p_partkey, 'https://archive.org/details/' || url_encode(p_name) AS pagina, 'https://archive.org/download/' || url_encode(p_name) || '/law.xml' AS arquivo, 'https://archive.org/search?query=' || url_encode(p_name) AS busca FROM (SELECT p_partkey, replace(p_name, ' ', '_') AS p_name FROM part)")
def _(spark, d):
    item = F.replace("p_name", F.lit(" "), F.lit("_"))
    return table(spark, d, "part").select("p_partkey", law.details_url(item).alias("pagina"), law.file_url(item, "law.xml").alias("arquivo"), law.search_url(item).alias("busca"))


@query("txt26_coverage_label", "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Rondônia, Brazil' WHEN 1 THEN 'São Paulo, Brazil' ELSE 'Brazil' END AS cobertura FROM customer")
def _(spark, d):
    place = F.element_at(F.array(*map(F.lit, ("ro", "SP", "federal", "nowhere"))), (c("c_custkey") % 4 + 1).cast("int"))
    return table(spark, d, "customer").select("c_custkey", law.coverage_label(place).alias("cobertura"))


@query("src13_archived_urls", "SELECT DISTINCT url FROM pages WHERE page_id % 4 <> 3")
def _(spark, d):
    code = F.element_at(F.array(*map(F.lit, ("200", "301", "302", "404"))), (c("page_id") % 4 + 1).cast("int"))
    return files.archived_urls(table(spark, d, "pages").select(c("url").alias("original"), code.alias("statuscode")))


@query("src21_raw_ids", "SELECT DISTINCT 'raw-ro-portal-lei-' || CASE WHEN c_custkey < 100000 THEN lpad(CAST(c_custkey AS VARCHAR), 5, '0') ELSE CAST(c_custkey AS VARCHAR) END AS raw_id FROM customer WHERE c_custkey % 3 <> 2")
def _(spark, d):
    """Three indexes, one of which is not there; with one that fails there is nothing."""
    k = c("c_custkey")
    index = lambda n: table(spark, d, "customer").where(k % 3 == n).select(F.lit("lei").alias("tipo"), k.cast("string").alias("numero"))
    if files.raw_ids([lambda: index(0), lambda: 1 // 0], "ro", "portal") is not None:
        raise ValueError("a part was taken for all")
    return files.raw_ids([lambda: index(0), lambda: None, lambda: index(1)], "ro", "portal")


@query("str9_full_rebuild", "SELECT p_name AS id FROM (SELECT DISTINCT p_name || '-' || p_partkey % 10 AS p_name FROM part) WHERE p_name NOT IN (SELECT p_name || '-' || p_partkey % 10 FROM part WHERE p_partkey % 10 < 3)")
def _(spark, d):
    p = table(spark, d, "part").selectExpr("concat(p_name, '-', p_partkey % 10) AS id", "p_partkey")
    return files.missing_files(p.select("id"), p.where("p_partkey % 10 < 3").select(F.concat("id", F.lit(".xml")).alias("name")))[0]


@query("txt28_resolve_capture", """WITH i AS (SELECT event_type AS tipo, CAST(user_id AS BIGINT) AS numero, arg_max(sha256(props), event_id) AS sha FROM events WHERE user_id % 10 <> 0 GROUP BY 1, 2)
SELECT 'ro' AS ente, 'portal' AS fonte, tipo, numero, 'https://archive.org/download/norma_ro_portal_' || tipo || '_' || printf('%04d-%04d', (numero - 1) // 1000 * 1000 + 1, (numero - 1) // 1000 * 1000 + 1000) || '/' || substr(sha1(from_hex('6ba7b8109dad11d180b400c04fd430c8') || encode(sha)), 1, 8) || '.pdf' AS url FROM i""")
def _(spark, d):
    """The newest of each number's captures, html ones passed over."""
    idx = index_rows(spark, d)
    raw = idx.where("numero != ''").select(F.lit("ro").alias("ente"), F.lit("portal").alias("fonte"), "tipo", c("numero").cast("bigint").alias("numero")).distinct()
    other = idx.where("numero != ''").withColumn("formato", F.lit("html")).withColumn("event_id", c("event_id") + 10**9)
    return captures.resolve(raw, idx.where("numero != ''").union(other), "event_id", suffix=".pdf")


_RAW = "CASE c_custkey % 5 WHEN 0 THEN 'raw-ro-portal-click-' || c_custkey % 200 WHEN 1 THEN 'raw-ro-porto-velho-casa-view-' || c_custkey % 90 WHEN 2 THEN 'raw-ro-portal-coddoc-' || c_custkey WHEN 3 THEN 'item-' || c_custkey ELSE 'raw-sp-portal-error-99999999999999999999' END"


@query("jn15_lineage", f"""WITH r AS (SELECT {_RAW} AS raw_id, c_custkey FROM customer),
p AS (SELECT *, CASE WHEN raw_id LIKE 'raw-%' THEN CASE WHEN raw_id LIKE 'raw-ro-porto-velho-%' THEN 'ro-porto-velho' ELSE split_part(raw_id, '-', 2) END END AS ente,
  CASE WHEN raw_id LIKE '%-casa-%' THEN 'casa' WHEN raw_id LIKE 'raw-%' THEN 'portal' END AS fonte,
  CASE WHEN raw_id LIKE '%-click-%' THEN 'click' WHEN raw_id LIKE '%-view-%' THEN 'view' END AS tipo,
  CASE WHEN c_custkey % 5 < 2 THEN CAST(regexp_extract(raw_id, '[0-9]+$') AS BIGINT) END AS numero FROM r),
i AS (SELECT event_type AS tipo, CAST(user_id AS BIGINT) AS numero, arg_max(substr(sha256(props), 1, 8), event_id) AS uuid5, arg_max('src-' || (event_id % 7), event_id) AS source FROM events WHERE user_id % 10 <> 0 GROUP BY 1, 2),
m AS (SELECT p.*, i.uuid5, i.source, CASE WHEN p.numero IS NOT NULL THEN 'norma_' || ente || '_' || fonte || '_' || p.tipo || '_' || printf('%04d-%04d', greatest(p.numero - 1, 0) // 1000 * 1000 + 1, greatest(p.numero - 1, 0) // 1000 * 1000 + 1000) END AS item
  FROM p LEFT JOIN i ON i.tipo = p.tipo AND i.numero = p.numero)
SELECT c_custkey, raw_id, ente, fonte, tipo, numero, item, uuid5, source,
  CASE WHEN ente IS NULL THEN 'https://archive.org/download/' || raw_id || '/' || raw_id || '_djvu.txt' WHEN uuid5 IS NOT NULL THEN 'https://archive.org/download/' || item || '/' || tipo || '-' || printf('%05d', numero) || '_' || uuid5 || '_djvu.txt' END AS url,
  CASE WHEN ente IS NULL THEN 'external' WHEN numero IS NULL THEN 'unidentified' WHEN uuid5 IS NULL THEN 'uncaptured' ELSE 'found' END AS hop FROM m""")  # fmt: skip
def _(spark, d):
    """From raw ids to recognised text: slug, key, bucket, newest pdf, source."""
    raw = table(spark, d, "customer").selectExpr(f"{_RAW} AS raw_id", "c_custkey")
    idx = index_rows(spark, d)
    pages = idx.withColumn("formato", F.lit("html")).withColumn("event_id", c("event_id") + 10**9)
    return captures.lineage(raw, idx.union(pages), "event_id", ["ro", "ro-porto-velho", "sp"], suffix="_djvu.txt")


@query("law4_law_fields", "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 2 THEN 'desconhecido' ELSE 'lei' END AS tipo, CASE o_orderkey % 3 WHEN 0 THEN CAST(o_orderkey AS VARCHAR) END AS numero, CAST(CASE o_orderkey % 3 WHEN 0 THEN year(o_orderdate) ELSE 0 END AS INT) AS ano FROM orders")
def _(spark, d):
    k, y = c("o_orderkey"), F.year("o_orderdate")
    name = F.when(k % 3 == 0, F.format_string("norma-ro-lei-%05d-%d", k, y)).when(k % 3 == 1, F.format_string("norma-ro-lei-fallback-portal-x-%d-%d", k, y)).otherwise("other")
    return table(spark, d, "orders").select("o_orderkey", flatten.law_fields(name, F.lit(None).cast("string")).alias("f")).select("o_orderkey", "f.*")


@query("law13_last_segment", V + "SELECT DISTINCT dispositivo_path AS path, CASE dispositivo_path WHEN 'ementa' THEN 'ementa' WHEN 'art-1' THEN 'art-1' WHEN 'art-1-par-1' THEN 'par-1' WHEN 'art-1-par-2' THEN 'par-2' WHEN 'art-2' THEN 'art-2' WHEN 'art-2-inc-1' THEN 'inc-1' ELSE 'ali-a' END AS ultimo FROM versoes")
def _(spark, d):
    return norm_versions(spark, d).select(c("dispositivo_path").alias("path")).distinct().withColumn("ultimo", F.element_at(law.segments(c("path")), -1))


@query("law15_citation", V + "SELECT DISTINCT lei_id, dispositivo_path AS path, 'Decreto nº ' || numero_lei || '/' || ano_lei || CASE WHEN dispositivo_path = 'art-2' THEN '. Art. 2º' ELSE '' END AS citacao FROM versoes WHERE tipo_lei = 'decreto' AND dispositivo_path IN ('ementa', 'art-2')")
def _(spark, d):
    v = norm_versions(spark, d).where("tipo_lei = 'decreto' AND dispositivo_path IN ('ementa', 'art-2')")
    return v.select("lei_id", c("dispositivo_path").alias("path"), law.citation(c("tipo_lei"), c("numero_lei"), c("ano_lei"), c("dispositivo_path")).alias("citacao")).distinct()


@query("law17_source_count", V + "SELECT num_fontes AS n, count(*) AS versoes FROM versoes GROUP BY 1")
def _(spark, d):
    return norm_versions(spark, d).groupBy(F.size(law.sources(c("fontes"))).alias("n")).agg(F.count("*").alias("versoes"))


_MARKS = "(VALUES ('ementa', 'ementa', 'Ementa'), ('art-1', 'art1', 'Art. 1º'), ('art-1-par-1', 'art1_par1', '§ 1º'), ('art-1-par-2', 'art1_par2', '§ 2º'), ('art-2', 'art2', 'Art. 2º'), ('art-2-inc-1', 'art2_cpt_inc1', 'I'), ('art-2-inc-1-ali-a', 'art2_cpt_inc1_alia', 'a)')) m(path, id, rotulo)"


@query("snk15_exchange_documents", V + f""", l AS (SELECT lei_id, urn_lex_lei AS urn, dispositivo_path AS path, dispositivo_parent_path AS up, dispositivo_ordem AS ordem, arg_max(texto, versao_id) AS body FROM versoes GROUP BY 1, 2, 3, 4, 5),
h AS (SELECT l.*, '<Dispositivo id="' || id || '"><Rotulo>' || rotulo || '</Rotulo><p>' || body || '</p>' AS head FROM l JOIN {_MARKS} USING (path)),
w3 AS (SELECT *, head || '</Dispositivo>' AS xml FROM h WHERE path = 'art-2-inc-1-ali-a'),
w2 AS (SELECT *, head || coalesce((SELECT xml FROM w3 WHERE w3.lei_id = h.lei_id AND w3.up = h.path), '') || '</Dispositivo>' AS xml FROM h WHERE path IN ('art-1-par-1', 'art-1-par-2', 'art-2-inc-1')),
w1 AS (SELECT *, head || coalesce((SELECT string_agg(xml, '' ORDER BY ordem, path) FROM w2 WHERE w2.lei_id = h.lei_id AND w2.up = h.path), '') || '</Dispositivo>' AS xml FROM h WHERE path IN ('ementa', 'art-1', 'art-2')),
a AS (SELECT * FROM w1 UNION ALL SELECT * FROM w2 UNION ALL SELECT * FROM w3)
SELECT lei_id, '<LexML><Metadado><Identificacao URN="' || coalesce(urn, '') || '"/></Metadado><Norma>' || string_agg(xml, '' ORDER BY ordem, path) || '</Norma></LexML>' AS xml
FROM a WHERE up IS NULL OR NOT EXISTS (SELECT 1 FROM l WHERE l.lei_id = a.lei_id AND l.path = a.up) GROUP BY lei_id, urn""")
def _(spark, d):
    return publish.lexml(norm_versions(spark, d))


@query("src12_archive_listing", "SELECT 'https://' || regexp_replace(url, '^https?://', '') || '.pdf' AS url, 'https://web.archive.org/web/20240101000000/' || url || '.pdf' AS snapshot FROM pages WHERE page_id % 2 = 0")
def _(spark, d):
    listing = table(spark, d, "pages").select(F.lit("20240101000000").alias("timestamp"), F.concat("url", F.lit(".pdf")).alias("original"), F.when(c("page_id") % 2 == 0, "200").otherwise("301").alias("statuscode"))
    return files.archive_rows(listing)
