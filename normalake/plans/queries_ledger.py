"""Queries for the ledger, the staging table, the capture index and sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from normalake.functions import identity as I
from normalake.operators import captures, coverage, ledger
from normalake.plans.base import query, table
from normalake.sources import generators

c = F.col

_STATUS = "CASE page_id % 4 WHEN 0 THEN 'pending' WHEN 1 THEN 'downloaded' WHEN 2 THEN 'bundled' ELSE 'failed' END"
_LEDGER = f"SELECT url, regexp_extract(url, '/(en|de|fr|es)/', 1) AS ente, 'portal' AS fonte, CASE WHEN page_id % 3 = 0 THEN 'lei' ELSE 'decreto' END AS tipo_documento, concat('k-', CAST(page_id AS STRING)) AS chave, {_STATUS} AS status, CASE WHEN page_id % 5 = 0 THEN concat('https://w.example/', CAST(page_id AS STRING)) END AS wayback_snapshot, page_id FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id) AS rn FROM pages) x WHERE rn = 1"
_RESOURCES = f"WITH r AS ({_LEDGER}) "


def resources(spark, d):
    first = table(spark, d, "pages").groupBy("url").agg(F.min("page_id").alias("page_id"))
    return first.select(
        "url", F.regexp_extract("url", "/(en|de|fr|es)/", 1).alias("ente"), F.lit("portal").alias("fonte"), F.when(c("page_id") % 3 == 0, "lei").otherwise("decreto").alias("tipo_documento"),
        F.concat(F.lit("k-"), c("page_id").cast("string")).alias("chave"), F.expr(_STATUS).alias("status"), F.when(c("page_id") % 5 == 0, F.concat(F.lit("https://w.example/"), c("page_id").cast("string"))).alias("wayback_snapshot"), "page_id",
    )


_LAWS = "SELECT o_orderkey AS id, o_orderpriority AS titulo, CAST(year(o_orderdate) AS INT) AS ano, CAST(o_orderdate AS DATE) AS data_publicacao, n_name AS ente, CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 10 = 1 THEN '' ELSE o_orderstatus END AS texto FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
_L = f"WITH leis AS ({_LAWS}) "


def laws(spark, d):
    o, cu, n = (table(spark, d, t) for t in ("orders", "customer", "nation"))
    k = c("o_orderkey") % 10
    return o.join(cu, c("o_custkey") == c("c_custkey")).join(n, c("c_nationkey") == c("n_nationkey")).select(
        c("o_orderkey").alias("id"), c("o_orderpriority").alias("titulo"), F.year("o_orderdate").alias("ano"), F.to_date("o_orderdate").alias("data_publicacao"), c("n_name").alias("ente"),
        F.when(k == 0, None).when(k == 1, "").otherwise(c("o_orderstatus")).alias("texto"),
    )


@query("src6_staging_scan", _LAWS)
def _(spark, d):
    return laws(spark, d)


@query("agg1_total", _L + "SELECT count(*) AS total FROM leis")
def _(spark, d):
    return laws(spark, d).agg(F.count("*").alias("total"))


@query("agg2_count_by_place", _L + "SELECT ente, count(*) AS total FROM leis GROUP BY 1")
def _(spark, d):
    return coverage.count_by(laws(spark, d), "ente")


@query("agg3_newest_years", _L + "SELECT ano, count(*) AS total FROM leis WHERE ano IS NOT NULL GROUP BY 1 ORDER BY 1 DESC LIMIT 10")
def _(spark, d):
    return coverage.newest_years(laws(spark, d))


@query("srt1_latest_laws", _L + "SELECT id, titulo, ano, data_publicacao, ente FROM leis WHERE ente = 'NATION_3' ORDER BY data_publicacao DESC NULLS LAST, id LIMIT 50")
def _(spark, d):
    return laws(spark, d).where(c("ente") == "NATION_3").select("id", "titulo", "ano", "data_publicacao", "ente").orderBy(c("data_publicacao").desc_nulls_last(), "id").limit(50)


@query("flt10_without_text", _L + "SELECT id FROM leis WHERE texto IS NULL OR texto = ''")
def _(spark, d):
    return laws(spark, d).where("texto IS NULL OR texto = ''").select("id")


@query("flt8_pending_queue", _RESOURCES + "SELECT url FROM r WHERE status = 'pending' AND ente = 'en' AND tipo_documento = 'lei' ORDER BY url LIMIT 10")
def _(spark, d):
    return ledger.pending(resources(spark, d), "en", "lei", 10).select("url")


@query("flt9_downloaded", _RESOURCES + "SELECT url, chave FROM r WHERE status = 'downloaded' AND ente = 'en' AND fonte = 'portal'")
def _(spark, d):
    return resources(spark, d).where("status = 'downloaded' AND ente = 'en' AND fonte = 'portal'").select("url", "chave")


@query("flt13_id_range", "SELECT k FROM (SELECT o_orderstatus || '-lei-' || o_orderkey AS k, o_orderkey AS n, o_orderstatus AS t FROM orders) WHERE t = 'F' AND n BETWEEN 100 AND 4000")
def _(spark, d):
    k = table(spark, d, "orders").select(F.concat("o_orderstatus", F.lit("-lei-"), c("o_orderkey").cast("string")).alias("k"))
    p = r"^(.*)-(\d+)$"
    return k.where((F.regexp_extract("k", p, 1) == "F-lei") & F.regexp_extract("k", p, 2).cast("bigint").between(100, 4000))


@query("flt16_confidence_gate", "SELECT event_id FROM events WHERE event_id % 17 <> 0 AND value / 100 >= 0.5")
def _(spark, d):
    v = F.when(c("event_id") % 17 == 0, F.lit(float("nan"))).otherwise(c("value") / 100)
    return table(spark, d, "events").withColumn("v", v).where(~F.isnan("v") & (c("v") >= 0.5)).select("event_id")


@query("flt17_freshness", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-15 12:00:00' - INTERVAL 24 HOUR AND ts <= TIMESTAMP '2024-01-15 12:00:00'")
def _(spark, d):
    now = F.lit("2024-01-15 12:00:00").cast("timestamp")
    return table(spark, d, "events").where((c("ts") >= now - F.expr("INTERVAL 24 HOURS")) & (c("ts") <= now)).select("event_id")


@query("flt18_archive_rows", "SELECT 'https://' || regexp_replace(url, '^https?://', '') || '.pdf' AS url FROM pages WHERE page_id % 3 = 0")
def _(spark, d):
    from normalake.sources.files import archive_rows

    listing = table(spark, d, "pages").select(F.concat(F.lit("2024010100000"), (c("page_id") % 10).cast("string")).alias("timestamp"), F.concat("url", F.lit(".pdf")).alias("original"), F.when(c("page_id") % 3 == 0, "200").otherwise("404").alias("statuscode"))
    return archive_rows(listing).select("url")


@query("flt19_json_predicate", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events WHERE json_extract(props, '$.k') IS NOT NULL")
def _(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k")).where("k IS NOT NULL")


@query("jn1_skip_existing", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey % 4 <> 0)")
def _(spark, d):
    done = table(spark, d, "orders").where("o_custkey % 4 <> 0").select(c("o_custkey").alias("c_custkey"))
    return ledger.skip_existing(table(spark, d, "customer").select("c_custkey"), done, "c_custkey")


@query("jn2_identity_map", "SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
def _(spark, d):
    return table(spark, d, "orders").join(table(spark, d, "customer"), c("o_custkey") == c("c_custkey")).select("o_orderkey", "c_name", "c_mktsegment")


@query("jn3_attach_snapshot", "SELECT c_custkey, (SELECT max_by(o_orderdate, o_orderkey) FROM orders WHERE o_custkey = c_custkey) AS snapshot FROM customer")
def _(spark, d):
    last = table(spark, d, "orders").groupBy("o_custkey").agg(F.max_by("o_orderdate", "o_orderkey").alias("snapshot"))
    return table(spark, d, "customer").join(last, c("c_custkey") == c("o_custkey"), "left").select("c_custkey", "snapshot")


@query("jn10_two_schemes", """WITH w AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'http://' ELSE 'https://' END || regexp_replace(url, '^https?://', '') AS url FROM pages WHERE url LIKE 'http%'),
s AS (SELECT url, min(page_id) AS snap FROM w WHERE page_id % 3 = 0 GROUP BY 1)
SELECT page_id, coalesce(a.snap, b.snap) AS snap FROM w LEFT JOIN s a ON a.url = w.url LEFT JOIN s b ON b.url = CASE WHEN w.url LIKE 'https:%' THEN 'http:' || substr(w.url, 7) ELSE 'https:' || substr(w.url, 6) END""")
def _(spark, d):
    """The snapshot under the address itself, else under its other scheme."""
    http = F.when(c("page_id") % 2 == 0, "http://").otherwise("https://")
    w = table(spark, d, "pages").where("url LIKE 'http%'").select("page_id", F.concat(http, I.without_scheme(c("url"))).alias("url"))
    return captures.first_hit(w, w.where("page_id % 3 = 0").groupBy("url").agg(F.min("page_id").alias("snap")), "snap").select("page_id", "snap")


@query("jn11_label_lookup", "SELECT n_nationkey, coalesce(r_name, 'Norma') AS rotulo FROM nation LEFT JOIN region ON n_regionkey = r_regionkey")
def _(spark, d):
    r = table(spark, d, "region")
    return table(spark, d, "nation").join(r, c("n_regionkey") == c("r_regionkey"), "left").select("n_nationkey", F.coalesce("r_name", F.lit("Norma")).alias("rotulo"))


@query("jn12_prefix_filter", "SELECT 'raw-ro-' || CASE WHEN c_custkey % 3 = 0 THEN 'portal' ELSE 'diario' END || '-lei-' || c_custkey AS raw_id FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 2 = 1")
def _(spark, d):
    """Raw ids of a place and source that have no sidecar yet."""
    raw = F.concat(F.lit("raw-ro-"), F.when(c("c_custkey") % 3 == 0, "portal").otherwise("diario"), F.lit("-lei-"), c("c_custkey").cast("string")).alias("raw_id")
    ids = table(spark, d, "customer")
    return ledger.without_sidecar(ids.select(raw), ids.where("c_custkey % 2 = 0").select(raw), "raw-ro-portal-")


@query("jn14_highest_number", """SELECT t AS template, coalesce(max(CASE t WHEN 'https://a.example/{num}.pdf' THEN CASE WHEN c_custkey % 2 = 0 THEN c_custkey END WHEN 'https://b.example/x{num}' THEN CASE WHEN c_custkey % 2 = 1 THEN c_custkey END END), 0) AS numero
FROM customer, (VALUES ('https://a.example/{num}.pdf'), ('https://b.example/x{num}'), ('https://c.example/{num}')) v(t) GROUP BY 1""")
def _(spark, d):
    k = c("c_custkey").cast("string")
    urls = table(spark, d, "customer").select(F.when(c("c_custkey") % 2 == 0, F.concat(F.lit("https://a.example/"), k, F.lit(".pdf"))).otherwise(F.concat(F.lit("https://b.example/x"), k)).alias("url"))
    return generators.highest(urls, ["https://a.example/{num}.pdf", "https://b.example/x{num}", "https://c.example/{num}"])


@query("snk3_insert_or_ignore", "WITH old AS (SELECT event_type AS k, min(event_id) AS v FROM events WHERE event_type < 'd' GROUP BY 1), new AS (SELECT event_type AS k, min(event_id) + 1000000 AS v FROM events GROUP BY 1) SELECT * FROM old UNION ALL SELECT * FROM new WHERE k NOT IN (SELECT k FROM old)")
def _(spark, d):
    e = table(spark, d, "events").select(c("event_type").alias("k"), c("event_id").alias("v"))
    old = e.where("k < 'd'").groupBy("k").agg(F.min("v").alias("v"))
    return ledger.insert_or_ignore(old, e.withColumn("v", c("v") + 1_000_000), "k", "v")


@query("snk4_insert_or_replace", "WITH old AS (SELECT c_custkey AS id, c_name AS a, c_mktsegment AS b FROM customer), new AS (SELECT o_custkey + 100 AS id, CASE WHEN count(*) % 2 = 0 THEN NULL ELSE CAST(count(*) AS VARCHAR) END AS a FROM orders GROUP BY 1) SELECT coalesce(o.id, n.id) AS id, CASE WHEN n.id IS NOT NULL THEN n.a ELSE o.a END AS a, o.b AS b FROM old o FULL JOIN new n ON o.id = n.id")
def _(spark, d):
    old = table(spark, d, "customer").select(c("c_custkey").alias("id"), c("c_name").alias("a"), c("c_mktsegment").alias("b"))
    new = table(spark, d, "orders").groupBy((c("o_custkey") + 100).alias("id")).agg(F.count("*").alias("n")).select("id", F.when(c("n") % 2 != 0, c("n").cast("string")).alias("a"))
    return ledger.insert_or_replace(old, new, "id", ["a"])


@query("snk5_update_status", _RESOURCES + "SELECT url, CASE WHEN page_id % 2 = 0 THEN 'bundled' ELSE status END AS status, CASE WHEN page_id % 6 = 0 THEN 'https://new.example' ELSE wayback_snapshot END AS wayback_snapshot FROM r")
def _(spark, d):
    r = resources(spark, d).withColumn("ultima_tentativa", F.lit(None).cast("timestamp"))
    changes = r.where(c("page_id") % 2 == 0).select("url", F.lit("bundled").alias("status"), F.when(c("page_id") % 3 == 0, "https://new.example").otherwise("").alias("snapshot"))
    return ledger.update_status(r, changes, F.lit("2024-01-01").cast("timestamp")).select("url", "status", "wayback_snapshot")


_CAP = "SELECT event_type AS tipo, CASE WHEN user_id % 10 = 0 THEN '' ELSE CAST(user_id AS STRING) END AS numero, '' AS rendicao, 'pdf' AS formato, substr({h}, 1, 8) AS uuid5, {h} AS sha256, CAST(ts AS STRING) AS captured_at, concat('src-', CAST(event_id % 7 AS STRING)) AS source, event_id FROM events"
_C = "WITH i AS (" + _CAP.format(h="sha256(props)") + ") "


def index_rows(spark, d):
    e = table(spark, d, "events")
    h = F.sha2("props", 256)
    return e.select(c("event_type").alias("tipo"), F.when(c("user_id") % 10 == 0, "").otherwise(c("user_id").cast("string")).alias("numero"), F.lit("").alias("rendicao"), F.lit("pdf").alias("formato"), F.substring(h, 1, 8).alias("uuid5"), h.alias("sha256"), c("ts").cast("string").alias("captured_at"), F.concat(F.lit("src-"), (c("event_id") % 7).cast("string")).alias("source"), "event_id")


@query("snk6_append_index", _C + "SELECT tipo, numero, sha256, source, event_id FROM i o WHERE event_id < 5000 UNION ALL SELECT tipo, numero, sha256, source, event_id FROM (SELECT *, row_number() OVER (PARTITION BY tipo, numero, sha256, CASE WHEN numero = '' THEN source END ORDER BY event_id) AS rn FROM i WHERE event_id >= 5000) n WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM i o WHERE o.event_id < 5000 AND o.tipo = n.tipo AND o.numero = n.numero AND o.sha256 = n.sha256 AND (n.numero <> '' OR o.source = n.source))")
def _(spark, d):
    """New rows, each also with a later copy in the same batch."""
    i = index_rows(spark, d).withColumn("captured_at", F.lpad(c("event_id").cast("string"), 12, "0"))
    new = i.where("event_id >= 5000")
    again = new.withColumn("captured_at", F.concat(F.lit("9"), "captured_at")).withColumn("event_id", -c("event_id"))
    return captures.append(i.where("event_id < 5000"), new.union(again)).select("tipo", "numero", "sha256", "source", "event_id")


@query("snk7_remove_promoted", _C + "SELECT event_id FROM i WHERE NOT EXISTS (SELECT 1 FROM i p WHERE p.numero = '' AND p.uuid5 = i.uuid5 AND p.source = i.source)")
def _(spark, d):
    i = index_rows(spark, d)
    return captures.remove(i, i.where("numero = ''")).select("event_id")


@query("win6_newest_capture", _C + "SELECT tipo, numero, max(event_id) AS event_id, max_by(sha256, event_id) AS sha256 FROM i GROUP BY 1, 2")
def _(spark, d):
    return captures.newest(index_rows(spark, d), "event_id", "tipo", "numero").select("tipo", "numero", "event_id", "sha256")


@query("txt13_name_collisions", "SELECT substr(sha256(props), 1, 1) AS uuid5, count(DISTINCT sha256(props)) AS conteudos FROM events GROUP BY 1 HAVING count(DISTINCT sha256(props)) > 1")
def _(spark, d):
    return captures.collisions(index_rows(spark, d).withColumn("uuid5", F.substring("sha256", 1, 1)))


@query("agg9_identities", _C + "SELECT DISTINCT tipo || '-' || printf('%05d', CAST(numero AS BIGINT)) AS chave FROM i WHERE numero <> ''")
def _(spark, d):
    return captures.identities(index_rows(spark, d))


@query("agg10_highest_by_kind", _C + "SELECT tipo, max(CAST(nullif(numero, '') AS BIGINT)) AS mais FROM i GROUP BY 1")
def _(spark, d):
    return index_rows(spark, d).groupBy("tipo").agg(F.max(F.nullif("numero", F.lit("")).cast("bigint")).alias("mais"))


@query("snk19_reconcile", _C + """, k AS (SELECT 'src-' || n AS source, 'lei' AS tipo, CAST(n AS VARCHAR) AS numero FROM range(0, 4) r(n)),
h AS (SELECT * FROM i WHERE numero = ''), f AS (SELECT k.tipo, k.numero, h.sha256, h.source, min(h.captured_at) AS captured_at FROM h JOIN k USING (source) GROUP BY 1, 2, 3, 4)
SELECT 'index' AS area, tipo, numero, sha256, source, count(*) AS n FROM i WHERE numero <> '' GROUP BY ALL
UNION ALL SELECT 'promoted', tipo, numero, sha256, source, 1 FROM f WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.numero = f.numero AND i.tipo = f.tipo AND i.sha256 = f.sha256)
UNION ALL SELECT 'holding', tipo, numero, sha256, source, count(*) FROM h WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.source = h.source) AND NOT EXISTS (SELECT 1 FROM f WHERE f.source = h.source AND substr(f.sha256, 1, 8) = h.uuid5) GROUP BY ALL""")
def _(spark, d):
    """Both areas afterwards: what was promoted, and what is still held."""
    i = index_rows(spark, d)
    known = spark.range(4).select(F.concat(F.lit("src-"), c("id").cast("string")).alias("source"), F.lit("lei").alias("tipo"), c("id").cast("string").alias("numero"))
    index, left = captures.reconcile(i.where("numero = ''"), known, i.where("numero != ''"))
    area = F.when(c("tipo") == "lei", "promoted").otherwise("index")
    both = index.select(area.alias("area"), "tipo", "numero", "sha256", "source").union(left.select(F.lit("holding"), "tipo", "numero", "sha256", "source"))
    return both.groupBy("area", "tipo", "numero", "sha256", "source").agg(F.count("*").alias("n"))


@query("set1_union_all", "SELECT 'c' AS k, c_name AS n FROM customer UNION ALL SELECT 's', s_name FROM supplier")
def _(spark, d):
    from normalake.sources.files import union_tolerant

    def broken():
        raise RuntimeError("down")

    one = lambda t, k: lambda: table(spark, d, t[0]).select(F.lit(k).alias("k"), c(t[1]).alias("n"))
    return union_tolerant([one(("customer", "c_name"), "c"), broken, one(("supplier", "s_name"), "s")])[0]


@query("set2_union_distinct", "SELECT regexp_replace(url, '^https?://', '') AS u FROM pages UNION SELECT regexp_replace(url, '^https?://', '') FROM pages")
def _(spark, d):
    u = table(spark, d, "pages").select(I.without_scheme(c("url")).alias("u"))
    return u.union(u).distinct()


@query("set3_except", "SELECT n FROM range(0, 3000) r(n) EXCEPT SELECT p_partkey FROM part")
def _(spark, d):
    return spark.range(3000).select(c("id").alias("n")).subtract(table(spark, d, "part").select(c("p_partkey").alias("n")))


@query("agg18_batch_counters", _RESOURCES + "SELECT count(*) AS total, count(*) FILTER (status = 'failed') AS falhas, 100.0 * count(*) FILTER (status = 'failed') / count(*) AS taxa, 100.0 * count(*) FILTER (status = 'failed') / count(*) > 20 AS excede FROM r")
def _(spark, d):
    bad = F.count_if(c("status") == "failed")
    rate = bad * 100.0 / F.count("*")
    return resources(spark, d).agg(F.count("*").alias("total"), bad.alias("falhas"), rate.cast("double").alias("taxa"), (rate > 20).alias("excede"))


@query("agg19_status_counters", _RESOURCES + "SELECT status, count(*) AS n FROM r GROUP BY 1")
def _(spark, d):
    return resources(spark, d).groupBy("status").agg(F.count("*").alias("n"))


@query("srt7_limit_after_skip", "SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) ORDER BY o_orderkey LIMIT 25")
def _(spark, d):
    done = table(spark, d, "customer").where("c_acctbal > 0").select(c("c_custkey").alias("o_custkey"))
    return ledger.skip_existing(table(spark, d, "orders"), done, "o_custkey").select("o_orderkey").orderBy("o_orderkey").limit(25)


@query("str7_paced_hosts", "WITH u AS (SELECT DISTINCT regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, url FROM pages) SELECT host, url, CAST(row_number() OVER (PARTITION BY host ORDER BY url) - 1 AS DOUBLE) * 1.5 AS wait FROM u")
def _(spark, d):
    u = table(spark, d, "pages").select(F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1).alias("host"), "url").distinct()
    return ledger.paced(u, "host", "url", 1.5)
