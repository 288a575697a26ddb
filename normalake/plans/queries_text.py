"""Queries for scalar functions, sources and text operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from normalake.functions import identity as I
from normalake.functions import law, text
from normalake.operators import sampling
from normalake.plans.base import query, table
from normalake.sources import files, generators
from normalake.sources.segmenter import against_gold, segment, structure

c = F.col


@query("txt1_clean_ocr", r"SELECT doc_id, regexp_replace(regexp_replace(coalesce(text, ''), '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g'), '^\s+|\s+$', '', 'g') AS t FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", text.clean_ocr(c("text")).alias("t"))


@query("txt2_normalize_search", r"SELECT doc_id, trim(regexp_replace(regexp_replace(strip_accents(lower(text)), '\s+', ' ', 'g'), '[^a-z0-9\s]', '', 'g')) AS t FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", text.normalize_search(c("text")).alias("t"))


@query("txt3_normalize_text", r"SELECT doc_id, trim(regexp_replace(nfc_normalize(text), '[\s\x0B\x1C-\x1F\x{85}\p{Z}]+', ' ', 'g')) AS t FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", text.normalize_text(c("text")).alias("t"))


@query("txt4_hash_text", "SELECT doc_id, CASE WHEN text <> '' THEN 'sha256:' || sha256(text) END AS h FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", text.hash_text(c("text")).alias("h"))


@query("txt5_strip_accents", "SELECT doc_id, md5(strip_accents(text)) AS h FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(text.strip_accents(c("text"))).alias("h"))


_TITLE = "concat(CASE o_orderkey % 5 WHEN 0 THEN 'LEI' WHEN 1 THEN 'LEI COMPLEMENTAR' WHEN 2 THEN 'DECRETO-LEI' WHEN 3 THEN 'RESOLUÇÃO' ELSE 'AVISO' END, CASE WHEN o_orderkey % 7 = 0 THEN ' ANO ' ELSE ' Nº ' END, CAST(o_orderkey AS STRING), ', DE 22 DE JUNHO DE ', CAST(year(o_orderdate) AS STRING))"


@query("txt6_title_identity", f"""WITH t AS (SELECT o_orderkey, {_TITLE} AS t FROM orders), k AS (SELECT *, CASE WHEN t LIKE 'LEI COMP%' THEN 'lc' WHEN t LIKE 'DECRETO-LEI%' THEN 'decreto-lei' WHEN t LIKE 'RESOL%' THEN 'resolucao' WHEN t LIKE 'LEI%' THEN 'lei' END AS k,
  TRY_CAST(nullif(regexp_extract(t, ' Nº ([0-9]+)', 1), '') AS BIGINT) AS n FROM t)
SELECT o_orderkey, CASE WHEN n > 0 THEN k END AS tipo, CASE WHEN k IS NOT NULL AND n > 0 THEN n END AS numero FROM k""")
def _(spark, d):
    t = table(spark, d, "orders").selectExpr("o_orderkey", f"{_TITLE} AS t")
    return t.select("o_orderkey", I.title_identity(c("t")).alias("i")).select("o_orderkey", "i.tipo", "i.numero")


_FILE = "concat(CASE o_orderkey % 6 WHEN 0 THEN 'L' WHEN 1 THEN 'LC' WHEN 2 THEN 'Res' WHEN 3 THEN 'DEC' WHEN 4 THEN 'DL' ELSE 'X' END, CAST(o_orderkey AS STRING), '.pdf')"


@query("txt7_file_identity", f"""SELECT o_orderkey, t AS tipo, t || '-' || printf('%05d', o_orderkey) AS chave FROM (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'lei' WHEN 1 THEN 'lc' WHEN 2 THEN 'resolucao' WHEN 3 THEN 'decreto' WHEN 4 THEN 'decreto-lei' END AS t FROM orders)""")
def _(spark, d):
    t = table(spark, d, "orders").selectExpr("o_orderkey", f"{_FILE} AS f")
    return t.select("o_orderkey", I.file_identity(c("f")).alias("i")).select("o_orderkey", "i.tipo", "i.chave")


_KEY = "concat(CASE o_orderkey % 4 WHEN 0 THEN 'lei' WHEN 1 THEN 'lei-complementar' WHEN 2 THEN 'coddoc' ELSE 'Decreto' END, '-', CASE WHEN o_orderkey % 9 = 0 THEN 'x' ELSE '' END, CAST(o_orderkey AS STRING))"


@query("txt8_key_identity", f"""WITH k AS (SELECT o_orderkey, lower({_KEY}) AS k FROM orders), p AS (SELECT *, regexp_extract(k, '^([a-z][a-z0-9-]*)-([0-9]+)$', 1) AS t, regexp_extract(k, '^([a-z][a-z0-9-]*)-([0-9]+)$', 2) AS n FROM k)
SELECT o_orderkey, CASE WHEN t NOT IN ('', 'coddoc') THEN t END AS tipo, CASE WHEN t NOT IN ('', 'coddoc') THEN CAST(n AS BIGINT) END AS numero FROM p""")
def _(spark, d):
    t = table(spark, d, "orders").selectExpr("o_orderkey", f"{_KEY} AS k")
    return t.select("o_orderkey", I.key_identity(c("k")).alias("i")).select("o_orderkey", "i.tipo", "i.numero")


@query("jn8_longest_prefix", """WITH r AS (SELECT c_custkey, 'raw-' || lower(replace(n_name, '_', '-')) || '-portal-' || c_custkey AS id FROM customer JOIN nation ON c_nationkey = n_nationkey), s AS (SELECT lower(replace(n_name, '_', '-')) AS slug FROM nation UNION ALL SELECT 'nation')
SELECT c_custkey, (SELECT max_by(slug, length(slug)) FROM s WHERE starts_with(substr(id, 5), slug || '-')) AS ente, 'portal' AS fonte, CAST(c_custkey AS VARCHAR) AS chave FROM r""")
def _(spark, d):
    nation = table(spark, d, "nation").withColumn("slug", F.lower(F.replace("n_name", F.lit("_"), F.lit("-"))))
    slugs = [r.slug for r in nation.select("slug").collect()] + ["nation"]  # 25 jurisdictions
    ids = table(spark, d, "customer").join(nation, c("c_nationkey") == c("n_nationkey")).select("c_custkey", F.concat(F.lit("raw-"), "slug", F.lit("-portal-"), c("c_custkey").cast("string")).alias("id"))
    return ids.select("c_custkey", I.raw_id_parts(c("id"), slugs).alias("p")).select("c_custkey", "p.*")


@query("txt10_buckets", "SELECT o_orderkey, CAST(CASE WHEN o_orderkey > 0 THEN ((o_orderkey - 1) // 1000) * 1000 + 1 ELSE 1 END AS BIGINT) AS lo, CAST(CASE WHEN o_orderkey > 0 THEN ((o_orderkey - 1) // 1000) * 1000 + 1000 ELSE 1000 END AS BIGINT) AS hi, printf('norma_ro_portal_lei_%04d-%04d', CASE WHEN o_orderkey > 0 THEN ((o_orderkey - 1) // 1000) * 1000 + 1 ELSE 1 END, CASE WHEN o_orderkey > 0 THEN ((o_orderkey - 1) // 1000) * 1000 + 1000 ELSE 1000 END) AS item FROM orders")
def _(spark, d):
    n = c("o_orderkey")
    return table(spark, d, "orders").select("o_orderkey", I.bucket_start(n).alias("lo"), I.bucket_end(n).alias("hi"), I.bucket_item(F.lit("RO"), F.lit("portal"), F.lit("lei"), n).alias("item"))


@query("txt11_names", r"SELECT page_id, regexp_replace(url, '[^a-zA-Z0-9_-]', '', 'g') AS nome, regexp_replace(url, '[^a-z0-9-]', '_', 'g') AS caminho FROM pages")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", I.safe_name(c("url")).alias("nome"), I.safe_path(c("url")).alias("caminho"))


@query("txt14_weekly_bundle", "SELECT event_id, printf('bundle-ro-portal-%dW%02d', isoyear(ts), weekofyear(ts)) AS pacote FROM events")
def _(spark, d):
    return table(spark, d, "events").select("event_id", I.bundle_id(F.lit("ro"), F.lit("portal"), c("ts")).alias("pacote"))


_SNAP = "concat('https://web.archive.org/web/', CAST(20240101000000 + page_id AS STRING), '/', url)"


@query("txt15_snapshots", f"SELECT page_id, regexp_extract({_SNAP}, '/web/([0-9]{{14}})', 1) AS quando, regexp_replace({_SNAP}, '(/web/[0-9]{{14}})/', '\\1id_/') AS bruto, CASE WHEN starts_with(url, 'https://') THEN 'http://' || substr(url, 9) WHEN starts_with(url, 'http://') THEN 'https://' || substr(url, 8) ELSE url END AS outro FROM pages")
def _(spark, d):
    p = table(spark, d, "pages").selectExpr("page_id", "url", f"{_SNAP} AS s")
    return p.select("page_id", I.snapshot_stamp(c("s")).alias("quando"), I.raw_snapshot(c("s")).alias("bruto"), I.flip_scheme(c("url")).alias("outro"))


@query("txt16_scheme", "SELECT page_id, 'https://' || regexp_replace(url, '^https?://', '') AS url FROM pages")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", F.concat(F.lit("https://"), I.without_scheme(c("url"))).alias("url"))


@query("txt19_item_of_url", "SELECT page_id, coalesce(nullif(regexp_extract('https://archive.org/details/' || replace(replace(url, '/', ''), '?', ''), '/(?:details|download)/([^/?#]+)', 1), ''), 'raw-' || page_id) AS item FROM pages")
def _(spark, d):
    u = F.concat(F.lit("https://archive.org/details/"), F.replace(F.replace("url", F.lit("/"), F.lit("")), F.lit("?"), F.lit("")))
    return table(spark, d, "pages").select("page_id", I.item_of_url(u, c("page_id").cast("string")).alias("item"))


@query("txt21_year_in_title", f"SELECT o_orderkey, CAST(nullif(regexp_extract({_TITLE}, '\\b((?:19|20)[0-9]{{2}})\\b', 1), '') AS INT) AS ano FROM orders")
def _(spark, d):
    return table(spark, d, "orders").selectExpr("o_orderkey", f"{_TITLE} AS t").select("o_orderkey", I.year_in_title(c("t")).alias("ano"))


@query("txt22_context", "WITH p AS (SELECT doc_id, text, instr(text, 'License') - 1 AS s FROM documents WHERE instr(text, 'License') > 0) SELECT doc_id, (CASE WHEN s > 30 THEN '…' ELSE '' END) || replace(substr(text, greatest(s - 30, 0) + 1, least(s + 37, length(text)) - greatest(s - 30, 0)), chr(10), ' ') || (CASE WHEN s + 37 < length(text) THEN '…' ELSE '' END) AS trecho FROM p")
def _(spark, d):
    p = table(spark, d, "documents").withColumn("s", F.instr("text", "License") - 1).where("s >= 0")
    return p.select("doc_id", text.context(c("text"), c("s"), c("s") + 7).alias("trecho"))


@query("txt23_last_segment", "SELECT c_custkey, list_last(string_split(replace(c_name, '#', '-'), '-')) AS numero FROM customer")
def _(spark, d):
    return table(spark, d, "customer").select("c_custkey", I.last_segment(F.replace("c_name", F.lit("#"), F.lit("-"))).alias("numero"))


@query("txt24_parsed_id", "SELECT o_orderkey, printf('norma-ro-lei-%05d-%d', o_orderkey, year(o_orderdate)) AS id, 'lei-' || o_orderkey || '.pdf' AS arquivo FROM orders")
def _(spark, d):
    n = c("o_orderkey").cast("string")
    return table(spark, d, "orders").select("o_orderkey", I.parsed_id(F.lit("ro"), F.lit("lei"), n, F.year("o_orderdate")).alias("id"), I.file_name(F.lit("LEI"), F.concat(F.lit("lei-"), n)).alias("arquivo"))


@query("txt25_prompt_truncation", "SELECT doc_id, substr(text, 1, 8000) AS t, length(text) > 8000 AS cortado FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", F.substring("text", 1, 8000).alias("t"), (F.length("text") > 8000).alias("cortado"))


@query("src23_meta_url", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'https://archive.org/download/ds-v' || o_orderkey || '/dataset_meta.json' END AS meta FROM orders")
def _(spark, d):
    url = F.concat(F.when(c("o_orderkey") % 2 == 0, "https://archive.org/download/ds-v").otherwise("https://example.org/download/ds-v"), c("o_orderkey").cast("string"), F.lit("/versoes.parquet"))
    return table(spark, d, "orders").select("o_orderkey", I.meta_url(url).alias("meta"))


@query("src11_html_links", r"""SELECT DISTINCT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || l AS link FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '(?i)href=[''"]?(/[^''" >]+)[''"]?', 1)) AS l FROM pages)""")
def _(spark, d):
    p = table(spark, d, "pages").select("page_id", "url", F.expr(r"""html""").alias("html"))
    return files.html_links(p, "url", "").where(F.startswith("link", F.lit("http"))).select("page_id", "link").distinct()


@query("txt18_join_url", "SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || '/x/y.pdf' AS raiz, 'https://e.org/a' AS absoluta FROM pages")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", I.join_url(c("url"), F.lit("/x/y.pdf")).alias("raiz"), I.join_url(c("url"), F.lit("https://e.org/a")).alias("absoluta"))


@query("src14_sequential_urls", "SELECT n AS num, replace(t, '{num}', CAST(n AS VARCHAR)) AS url FROM range(1, 5001) r(n), (VALUES ('https://a.example/{num}.pdf'), ('https://b.example/{num}')) v(t) WHERE NOT (t LIKE 'https://a%' AND n IN (SELECT c_custkey FROM customer))")
def _(spark, d):
    known = table(spark, d, "customer").select(F.format_string("https://a.example/%d.pdf", "c_custkey").alias("url"))
    return generators.sequential(spark, ["https://a.example/{num}.pdf", "https://b.example/{num}"], 1, 5000, known).select("num", "url")


@query("src15_state_portal", "SELECT printf('lc-%05d', n) AS chave, 'Lei Complementar nº ' || n || ' (Rondônia)' AS titulo, 'https://portal.example/LC' || n || '.pdf' AS url FROM range(1, (SELECT max(c_custkey) FROM customer) + 1) r(n)")
def _(spark, d):
    last = table(spark, d, "customer").agg(F.max("c_custkey")).first()[0]
    return generators.state_portal(spark, "lc", 1, last, "https://portal.example/")


@query("src16_federal", "SELECT o_orderkey AS num, CAST(year(o_orderdate) + 5 AS INT) AS year, CASE WHEN year(o_orderdate) + 5 >= 2003 THEN printf('https://f.example/_ato%d-%d/%d/lei/l%d.htm', 2003 + ((year(o_orderdate) + 5 - 2003) // 4) * 4, 2006 + ((year(o_orderdate) + 5 - 2003) // 4) * 4, year(o_orderdate) + 5, o_orderkey) ELSE 'https://f.example/leis/L' || o_orderkey || '.htm' END AS url FROM orders")
def _(spark, d):
    o = table(spark, d, "orders").select(c("o_orderkey").alias("num"), (F.year("o_orderdate") + 5).cast("int").alias("year"))
    return generators.federal(o.select("num"), o, "https://f.example/")


@query("src17_parse_all", "SELECT printf('lei-%05d', n) AS chave FROM range(1, (SELECT max(p_partkey) FROM part) + 1) r(n)")
def _(spark, d):
    return generators.parse_all(spark, "lei", 1, table(spark, d, "part").agg(F.max("p_partkey")).first()[0])


@query("jn9_year_segment", "SELECT o_orderkey, CASE WHEN y >= 2003 THEN (2003 + ((y - 2003) // 4) * 4) || '-' || (2006 + ((y - 2003) // 4) * 4) END AS faixa FROM (SELECT o_orderkey, year(o_orderdate) + 5 AS y FROM orders)")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", I.year_segment(F.year("o_orderdate") + 5).alias("faixa"))


@query("law11_roman", "WITH d AS (SELECT DISTINCT p_size AS n FROM part) SELECT n, ['','X','XX','XXX','XL','L'][n // 10 + 1] || ['','I','II','III','IV','V','VI','VII','VIII','IX'][n % 10 + 1] AS romano, CASE WHEN n BETWEEN 1 AND 9 THEN n || 'º' ELSE CAST(n AS VARCHAR) END AS ordinal FROM d")
def _(spark, d):
    return table(spark, d, "part").select(c("p_size").alias("n")).distinct().select("n", law.roman(c("n")).alias("romano"), law.ordinal(c("n")).alias("ordinal"))


@query("law5_parse_date", "SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS dia FROM orders")
def _(spark, d):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    week = F.format_string("%04d-W%02d-%d", F.extract(F.lit("YEAROFWEEK"), "o_orderdate"), F.weekofyear("o_orderdate"), F.weekday("o_orderdate") + 1)
    raw = F.when(c("o_orderkey") % 6 == 0, F.concat(F.substring(day, 1, 8), F.lit("45"))).when(c("o_orderkey") % 6 == 3, F.replace(day, F.lit("-"))).when(c("o_orderkey") % 6 == 1, week).when(c("o_orderkey") % 3 == 1, F.concat(day, F.lit("Z"))).otherwise(F.concat(day, F.lit("-03:00")))
    return table(spark, d, "orders").select("o_orderkey", law.parse_date(raw).alias("dia"))


@query("law7_start_kind", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'vacatio-legis' WHEN 1 THEN 'data-publicacao' WHEN 2 THEN 'texto-lei-alteradora' ELSE 'data-publicacao' END AS inicio FROM events")
def _(spark, d):
    k = c("event_id") % 4
    return table(spark, d, "events").select("event_id", law.start_kind(F.when(k == 0, "vacatio-legis"), k <= 1, F.when(k == 2, "lei-1").otherwise("")).alias("inicio"))


@query("law8_booleans", "SELECT event_id, event_id % 3 <> 2 AS diverge FROM events")
def _(spark, d):
    k = c("event_id") % 3
    return table(spark, d, "events").select("event_id", law.is_true(F.when(k == 0, " TRUE ").when(k == 1, "1").otherwise("no")).alias("diverge"))


@query("law22_heading_level", "SELECT DISTINCT p_size AS depth, least(6, 4 + p_size) AS nivel FROM part")
def _(spark, d):
    return table(spark, d, "part").select(c("p_size").alias("depth")).distinct().withColumn("nivel", law.heading_level(c("depth")))


@query("set5_distinct_lines", r"SELECT doc_id, string_agg(l, chr(10) ORDER BY i) AS linhas FROM (SELECT doc_id, l, min(i) AS i FROM (SELECT doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) AS i FROM (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')) AS ls FROM documents)) WHERE l <> '' GROUP BY 1, 2) GROUP BY 1")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", F.array_join(text.distinct_lines(c("text")), "\n").alias("linhas")).where("linhas <> ''")


@query("flt14_minimum_length", "SELECT doc_id FROM documents WHERE length(text) >= 200")
def _(spark, d):
    return table(spark, d, "documents").where(F.length("text") >= 200).select("doc_id")


@query("srt8_stratified_sample", "SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(doc_id || ':42'), doc_id) AS rn FROM documents) WHERE rn <= 12")
def _(spark, d):
    return sampling.per_source(table(spark, d, "documents"), "source", "doc_id", 5, floor=12, cap=40).select("doc_id", "source")


@query("agg17_pool_manifest", "WITH p AS (SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY md5(doc_id || ':42'), doc_id) AS rn FROM documents) WHERE rn <= 12) SELECT source, count(*) AS available, count(p.doc_id) AS picked, count(*) FILTER (p.doc_id IS NOT NULL AND length(text) >= 200) AS kept, count(*) FILTER (p.doc_id IS NOT NULL AND length(text) < 200) AS skipped FROM documents d LEFT JOIN p USING (doc_id) GROUP BY 1")
def _(spark, d):
    docs = table(spark, d, "documents")
    return sampling.pool_manifest(docs, sampling.per_source(docs, "source", "doc_id", 12), "source", "doc_id", "text")


#: The pieces of a norm's text by order of k: text, category of a piece that is a span, article number.
_PIECES = [
    ("'LEI Nº ' || CAST(k AS STRING) || ', DE 1990. '", None, None),
    ("'Dispõe sobre o caso ' || CAST(k AS STRING) || '.'", "'ementa'", None),
    ("' O PRESIDENTE DA REPÚBLICA. '", None, None),
    ("'Art. 1º'", "'art_marcador'", "1"),
    ("' Fica criado o cargo ' || CAST(k AS STRING) || '. '", None, None),
    ("'Art. ' || CAST(2 + k % 5 AS STRING) || 'º'", "'art_marcador'", "2 + k % 5"),
    ("' O órgão tem: '", None, None),
    ("'I -'", "'inc_marcador'", None),
    ("' um; conforme o inciso '", None, None),
    ("'II -'", None, None),
    ("' dois; '", None, None),
    ("'a)'", "'ali_marcador'", None),
    ("' letra; '", None, None),
    ("CASE WHEN k % 2 = 0 THEN '§ 1º' ELSE 'caso do § 2º' END", "CASE WHEN k % 2 = 0 THEN 'par_marcador' END", None),
    ("' Regra. '", None, None),
    ("'Parágrafo único'", "'par_marcador'", None),
    ("'. Fim do n. 3. '", None, None),
    ("CASE WHEN k % 3 = 0 THEN 'Art. 9º' ELSE 'Art. 1º-A' END", "'art_marcador'", "CASE WHEN k % 3 = 0 THEN 9 ELSE 1 END"),
    ("' '", None, None),
    ("CASE WHEN k % 4 = 0 THEN 'Vale a Lei n. 5.' ELSE 'Esta Lei entra em vigor na data.' END", "CASE WHEN k % 4 <> 0 THEN 'vigencia' END", None),
    ("' '", None, None),
    ("'Art. 10'", "'art_marcador'", "10"),
    ("' '", None, None),
    ("'Revogam-se as disposições em contrário.'", "'revogacao'", None),
]


#: Texts that a task makes and segments.
TEXTS_OF_A_TASK = 50_000


def norm_texts(spark, d):
    """doc, text: a norm for each order; every seventh has no text, and every
    seventh but one no structure."""
    whole = "concat(" + ", ".join(t for t, _, _ in _PIECES) + ")"
    keys = table(spark, d, "orders").selectExpr("o_orderkey AS k")
    # keys are small in files, texts are long work: tasks by number of rows, not by size of files
    keys = keys.repartition(max(spark.sparkContext.defaultParallelism, -(-keys.count() // TEXTS_OF_A_TASK)), "k")
    return keys.selectExpr("k AS doc", f"CASE k % 7 WHEN 0 THEN NULL WHEN 1 THEN 'Nada aqui.' ELSE {whole} END AS text")


def _pieces_sql() -> str:
    """Where each piece stands follows from the lengths of those before it."""
    each = " UNION ALL ".join(f"SELECT k, {i} AS i, {t.replace('STRING', 'VARCHAR')} AS t, {c or 'NULL'} AS category, {n or 'NULL'} AS number FROM o" for i, (t, c, n) in enumerate(_PIECES))
    return f"""WITH o AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 7 > 1), p AS ({each}),
q AS (SELECT *, sum(length(t)) OVER (PARTITION BY k ORDER BY i) AS upto FROM p),
s AS (SELECT k AS doc, category, CAST(upto - length(t) AS BIGINT) AS "start", CAST(upto AS BIGINT) AS "end", CAST(number AS BIGINT) AS number FROM q WHERE category IS NOT NULL) """


_SEG = _pieces_sql()


@query("seg11_segment", _SEG + "SELECT * FROM s")
def _(spark, d):
    """SEG1 to SEG11: all categories together."""
    return segment(norm_texts(spark, d))


for _k, _name in {"seg1_articles": "art_marcador", "seg2_paragraphs": "par_marcador", "seg4_roman_items": "inc_marcador", "seg5_item_markers": "ali_marcador", "seg7_entry_into_force": "vigencia", "seg8_revocation": "revogacao", "seg10_summary": "ementa"}.items():

    @query(_k, _SEG + f"SELECT doc, \"start\", \"end\" FROM s WHERE category = '{_name}'")
    def _(spark, d, name=_name):
        return segment(norm_texts(spark, d)).where(F.col("category") == name).select("doc", "start", "end")


@query("seg12_against_gold", _SEG + """, g AS (SELECT * FROM s WHERE doc % 5 <> 0 AND category IN ('art_marcador', 'ementa', 'vigencia')),
n AS (SELECT category, CAST((SELECT count(*) FROM g WHERE g.category = c.category) AS BIGINT) AS gold, CAST(count(*) AS BIGINT) AS pred, CAST(count(*) FILTER (s.doc % 5 <> 0) AS BIGINT) AS tp FROM (SELECT DISTINCT category FROM g) c JOIN s USING (category) GROUP BY 1),
a AS (SELECT * FROM n UNION ALL SELECT 'MICRO', CAST(sum(gold) AS BIGINT), CAST(sum(pred) AS BIGINT), CAST(sum(tp) AS BIGINT) FROM n)
SELECT category, gold, pred, tp AS exact_tp, CAST(tp AS DOUBLE) / pred AS exact_p, CAST(tp AS DOUBLE) / gold AS exact_r FROM a""")
def _(spark, d):
    """SEG12: gold marks three categories, and nothing in every fifth norm."""
    gold = against_gold(_gold(spark, d))[0]
    return gold.select("category", "gold", "pred", "exact_tp", "exact_p", "exact_r")


@query("seg13_errors", _SEG + "SELECT category, 'fp' AS kind, count(*) AS n FROM s WHERE doc % 5 = 0 AND category IN ('art_marcador', 'ementa', 'vigencia') GROUP BY 1")
def _(spark, d):
    return against_gold(_gold(spark, d))[1].groupBy("category", "kind").agg(F.count("*").alias("n"))


def _gold(spark, d):
    """Texts with the spans that their making gives."""
    spans, at = [], "0L"
    for t, kind, _ in _PIECES:
        if kind and kind.strip("'") in ("art_marcador", "ementa") or kind and "vigencia" in kind:
            spans.append(f"if(({kind}) IS NOT NULL, named_struct('category', {kind}, 'start', {at}, 'end', {at} + length({t})), NULL)")
        at = f"{at} + length({t})"
    label = f"CASE WHEN doc % 7 > 1 AND doc % 5 <> 0 THEN array_compact(array({', '.join(spans)})) ELSE array() END"
    return norm_texts(spark, d).selectExpr("*", "doc AS k").selectExpr("doc", "text", f"{label} AS label")


@query("seg14_structure", _SEG + """, w AS (SELECT o_orderkey AS doc FROM orders), n AS (SELECT doc, number AS n, "start" FROM s WHERE category = 'art_marcador'),
m AS (SELECT doc, max(n) AS most FROM n GROUP BY 1), gaps AS (SELECT doc, x AS n FROM (SELECT doc, unnest(range(1, most + 1)) AS x FROM m) t WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.doc = t.doc AND n.n = t.x)),
wrong AS (SELECT doc, n, "start" FROM (SELECT *, max(n) OVER (PARTITION BY doc ORDER BY "start" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM n) WHERE n < top)
SELECT doc, kind, '' AS numbers FROM w, (VALUES ('no_articles', 'art_marcador'), ('no_ementa', 'ementa'), ('no_vigencia', 'vigencia')) v(kind, category) WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.doc = w.doc AND s.category = v.category)
UNION ALL SELECT doc, 'missing_articles', string_agg(n, ',' ORDER BY n) FROM gaps GROUP BY 1
UNION ALL SELECT doc, 'out_of_order', string_agg(n, ',' ORDER BY "start") FROM wrong GROUP BY 1""")
def _(spark, d):
    return structure(norm_texts(spark, d)).withColumn("numbers", F.array_join(c("numbers").cast("array<string>"), ","))
