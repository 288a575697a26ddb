"""Queries over the versions table: the read side."""

from __future__ import annotations

from pyspark.sql import functions as F

from normalake.functions import law, text
from normalake.operators import coverage, provisions, quality, search
from normalake.plans.base import query, table
from normalake.plans.norm_versions import CTE, norm_versions
from normalake.schema import EXPORT_COLUMNS, VERSIONS

V = f"WITH {CTE} "
_ORDER = "(dispositivo_path = 'ementa') DESC, dispositivo_ordem, dispositivo_path, versao_id"
_ONE = f"(SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY lei_id ORDER BY {_ORDER}) AS _rn FROM versoes WHERE {{}}) WHERE _rn = 1)"
_TERM = "brand#2"
_HIT = f"ate IS NULL AND texto_normalizado ILIKE '%{_TERM}%'"


@query("src1_versions_view", V + "SELECT * FROM versoes")
def _(spark, d):
    return norm_versions(spark, d)


@query("src2_row_count", "SELECT count(*) AS n FROM lineitem")
def _(spark, d):
    return table(spark, d, "lineitem").agg(F.count("*").alias("n"))


@query("prj2_except_column", "SELECT * EXCLUDE (p_retailprice) FROM part")
def _(spark, d):
    return table(spark, d, "part").drop("p_retailprice")


@query("prj3_list_columns", "SELECT CAST(o_orderkey AS BIGINT) AS id, o_orderpriority AS titulo, CAST(year(o_orderdate) AS INT) AS ano, CAST(o_orderdate AS DATE) AS data_publicacao, o_orderstatus AS tipo_lei FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("titulo"), F.year("o_orderdate").alias("ano"), F.to_date("o_orderdate").alias("data_publicacao"), F.col("o_orderstatus").alias("tipo_lei"))


@query("prj5_derived_key", V + "SELECT versao_id, lei_id || '|' || dispositivo_path AS chave, CASE WHEN lei_revogada THEN lei_id END AS revogada, urn_lex_lei || '!' || dispositivo_path AS urn FROM versoes")
def _(spark, d):
    return norm_versions(spark, d).select("versao_id", F.concat("lei_id", F.lit("|"), "dispositivo_path").alias("chave"), F.when(F.col("lei_revogada"), F.col("lei_id")).alias("revogada"), F.concat("urn_lex_lei", F.lit("!"), "dispositivo_path").alias("urn"))


@query("prj10_browse_with_count", V + f"SELECT *, 0 AS match_count FROM {_ONE.format('ate IS NULL')} ORDER BY lei_id LIMIT 20")
def _(spark, d):
    return search.grouped(norm_versions(spark, d), "")


@query("flt1_optional_filters", V + "SELECT count(*) AS n FROM versoes WHERE ate IS NULL AND ente = 'nation_11'")
def _(spark, d):
    return norm_versions(spark, d).where(search.predicates("", ente="nation_11", kinds=[], year=0)).agg(F.count("*").alias("n"))


@query("flt2_in_force", V + "SELECT versao_id FROM versoes WHERE ate IS NULL")
def _(spark, d):
    return norm_versions(spark, d).where("ate IS NULL").select("versao_id")


@query("flt3_text_ilike", V + f"SELECT versao_id, texto FROM versoes WHERE {_HIT}")
def _(spark, d):
    return norm_versions(spark, d).where(search.predicates(f" {_TERM} ")).select("versao_id", "texto")


@query("flt4_text_like", "SELECT doc_id FROM documents WHERE text LIKE '%License%'")
def _(spark, d):
    return table(spark, d, "documents").where(F.col("text").like(text.like_pattern("License"))).select("doc_id")


@query("flt5_kind_aliases", V + "SELECT tipo_lei, count(*) AS n FROM versoes WHERE ate IS NULL AND tipo_lei IN ('lei.complementar', 'lc') GROUP BY 1")
def _(spark, d):
    return norm_versions(spark, d).where(search.predicates(kinds=["lei.complementar", "", "lc"])).groupBy("tipo_lei").agg(F.count("*").alias("n"))


@query("flt6_year", V + "SELECT versao_id FROM versoes WHERE ate IS NULL AND year(em) = 1998")
def _(spark, d):
    return norm_versions(spark, d).where(search.predicates(year=1998)).select("versao_id")


@query("flt7_point_in_time", V + "SELECT versao_id FROM versoes WHERE em <= DATE '1998-06-30' AND (ate IS NULL OR ate > DATE '1998-06-30') AND NOT dispositivo_revogado")
def _(spark, d):
    return search.as_of(norm_versions(spark, d), "1998-06-30").select("versao_id")


@query("flt7_point_in_time_corrected", V + "SELECT versao_id FROM versoes WHERE em <= DATE '1998-06-30' AND (ate IS NULL OR ate > DATE '1998-06-30')")
def _(spark, d):
    return search.as_of(norm_versions(spark, d), "1998-06-30", True).select("versao_id")


@query("flt11_known_kinds", V + "SELECT DISTINCT tipo_lei FROM versoes WHERE tipo_lei IS NOT NULL AND tipo_lei <> 'desconhecido'")
def _(spark, d):
    return search.known_kinds(norm_versions(spark, d))


@query("flt12_folded_contains", "SELECT doc_id FROM documents WHERE contains(strip_accents(lower(text)), 'cion')")
def _(spark, d):
    return table(spark, d, "documents").where(text.contains_folded(F.col("text"), "Ción")).select("doc_id")


@query("flt20_point_lookup", V + "SELECT * FROM versoes WHERE lei_id = 'norm-00042'")
def _(spark, d):
    return search.law_rows(norm_versions(spark, d), "norm-00042")


@query("win1_representative", V + f"SELECT lei_id, versao_id FROM {_ONE.format('ate IS NULL')}")
def _(spark, d):
    return search.representative(norm_versions(spark, d).where("ate IS NULL")).select("lei_id", "versao_id")


@query("win2_grouped_search", V + f"""SELECT * EXCLUDE (_rn) FROM (SELECT *, CAST(count(*) OVER (PARTITION BY lei_id) AS INT) AS match_count,
  row_number() OVER (PARTITION BY lei_id ORDER BY dispositivo_ordem, dispositivo_path, versao_id) AS _rn FROM versoes WHERE {_HIT}) WHERE _rn = 1 ORDER BY lei_id LIMIT 20""")
def _(spark, d):
    return search.grouped(norm_versions(spark, d), _TERM)


@query("agg4_count_browse", V + "SELECT CAST(count(DISTINCT lei_id) AS BIGINT) AS cnt FROM versoes WHERE ate IS NULL")
def _(spark, d):
    return search.count(norm_versions(spark, d))


@query("agg4_count_text", V + f"SELECT CAST(count(*) AS BIGINT) AS cnt FROM versoes WHERE {_HIT}")
def _(spark, d):
    return search.count(norm_versions(spark, d), _TERM)


@query("agg4_count_grouped", V + f"SELECT CAST(count(DISTINCT lei_id) AS BIGINT) AS cnt FROM versoes WHERE {_HIT}")
def _(spark, d):
    return search.count_grouped(norm_versions(spark, d), _TERM)


@query("agg5_coverage_stats", V + """SELECT count(DISTINCT lei_id) AS leis, count(DISTINCT lei_id || '|' || dispositivo_path) AS dispositivos, count(*) AS versoes,
  count(DISTINCT CASE WHEN lei_revogada THEN lei_id END) AS leis_revogadas, count(DISTINCT CASE WHEN tem_divergencia THEN lei_id END) AS leis_com_divergencia,
  CAST(min(ano_lei) AS INT) AS ano_min, CAST(max(ano_lei) AS INT) AS ano_max, max(vigente_em) AS vigente_em_max FROM versoes""")
def _(spark, d):
    return coverage.stats(norm_versions(spark, d))


@query("agg6_coverage_by_place", V + "SELECT ente, count(DISTINCT lei_id) AS leis, count(DISTINCT lei_id || '|' || dispositivo_path) AS dispositivos, CAST(min(ano_lei) AS INT) AS ano_min, CAST(max(ano_lei) AS INT) AS ano_max FROM versoes GROUP BY ente")
def _(spark, d):
    return coverage.by_place(norm_versions(spark, d))


@query("agg7_places", V + "SELECT DISTINCT ente FROM versoes WHERE ente IS NOT NULL AND ente <> ''")
def _(spark, d):
    return search.places(norm_versions(spark, d))


@query("agg8_contents", V + "SELECT DISTINCT dispositivo_path, dispositivo_tipo, dispositivo_parent_path, dispositivo_ordem FROM versoes WHERE lei_id = 'norm-00042'")
def _(spark, d):
    return coverage.contents(norm_versions(spark, d), "norm-00042")


@query("srt2_second_page", V + f"SELECT versao_id FROM versoes WHERE {_HIT} ORDER BY lei_id, dispositivo_path, versao_id LIMIT 100 OFFSET 100")
def _(spark, d):
    return search.search(norm_versions(spark, d), _TERM, page=1, size=5000).select("versao_id")


@query("srt3_recent", V + f"SELECT * FROM {_ONE.format('ate IS NULL')} ORDER BY data_publicacao DESC NULLS LAST, ano_lei DESC NULLS LAST, lei_id DESC LIMIT 8")
def _(spark, d):
    return search.recent(norm_versions(spark, d))


@query("srt9_total_pages", V + "SELECT CAST(greatest(1, ceil(count(DISTINCT lei_id) / 20.0)) AS BIGINT) AS pages FROM versoes WHERE ate IS NULL")
def _(spark, d):
    return search.total_pages(search.count(norm_versions(spark, d)))


@query("srt11_latency_probe", V + "SELECT versao_id FROM versoes WHERE texto LIKE '%economy%' AND ate IS NULL ORDER BY versao_id LIMIT 10")
def _(spark, d):
    return norm_versions(spark, d).where(F.col("texto").like("%economy%") & F.col("ate").isNull()).select("versao_id").orderBy("versao_id").limit(10)


@query("win3_end_dates", """WITH b AS (SELECT DISTINCT l_partkey AS lei, l_linenumber AS ln, CAST(l_shipdate AS DATE) AS em FROM lineitem),
v AS (SELECT CAST(lei AS VARCHAR) AS lei_id, CAST(ln AS VARCHAR) AS dispositivo_path, em AS pos, CASE WHEN month(em) <> 2 THEN em END AS em,
  CASE WHEN ln = 3 THEN DATE '2003-01-01' END AS own_end, CASE WHEN ln > 4 THEN DATE '2004-01-01' END AS ancestor_end, CASE WHEN lei % 2 = 0 THEN DATE '2005-01-01' END AS law_end FROM b)
SELECT *, CASE WHEN lead(1) OVER w IS NOT NULL THEN lead(em) OVER w ELSE coalesce(own_end, ancestor_end, law_end) END AS ate FROM v WINDOW w AS (PARTITION BY lei_id, dispositivo_path ORDER BY pos)""")
def _(spark, d):
    b = table(spark, d, "lineitem").select("l_partkey", "l_linenumber", F.to_date("l_shipdate").alias("day")).distinct()
    day = lambda s: F.lit(s).cast("date")
    v = b.select(F.col("l_partkey").cast("string").alias("lei_id"), F.col("l_linenumber").cast("string").alias("dispositivo_path"), F.col("day").alias("pos"), F.when(F.month("day") != 2, F.col("day")).alias("em"), F.when(F.col("l_linenumber") == 3, day("2003-01-01")).alias("own_end"), F.when(F.col("l_linenumber") > 4, day("2004-01-01")).alias("ancestor_end"), F.when(F.col("l_partkey") % 2 == 0, day("2005-01-01")).alias("law_end"))
    return provisions.end_dates(v)


@query("win4_sibling_order", V + "SELECT versao_id, row_number() OVER (PARTITION BY lei_id, dispositivo_parent_path ORDER BY dispositivo_path, em) - 1 AS ordem FROM versoes")
def _(spark, d):
    return provisions.sibling_order(norm_versions(spark, d).select("versao_id", "lei_id", "dispositivo_parent_path", "dispositivo_path", "em"), "dispositivo_path", "em").select("versao_id", "ordem")


@query("win5_nearest_ancestor", V + """, p AS (SELECT DISTINCT lei_id, dispositivo_path AS path, dispositivo_parent_path AS parent, CASE WHEN dispositivo_revogado THEN dispositivo_revogado_em END AS v FROM versoes),
r AS (SELECT lei_id, path, parent, v, (SELECT v FROM p q WHERE q.lei_id = p.lei_id AND q.path = p.parent) AS v1, (SELECT parent FROM p q WHERE q.lei_id = p.lei_id AND q.path = p.parent) AS g FROM p)
SELECT lei_id, path, parent, v, coalesce(v1, (SELECT v FROM p q WHERE q.lei_id = r.lei_id AND q.path = r.g)) AS inherited FROM r""")
def _(spark, d):
    p = norm_versions(spark, d).select("lei_id", F.col("dispositivo_path").alias("path"), F.col("dispositivo_parent_path").alias("parent"), F.when(F.col("dispositivo_revogado"), F.col("dispositivo_revogado_em")).alias("v")).distinct()
    return provisions.nearest_ancestor(p, "v")


@query("win7_current_rows", V + "SELECT versao_id FROM (SELECT *, row_number() OVER (PARTITION BY lei_id, dispositivo_path ORDER BY (ate IS NULL) DESC, em DESC, versao_id DESC) AS rn FROM versoes) WHERE rn = 1")
def _(spark, d):
    return provisions.current(norm_versions(spark, d).select("lei_id", "dispositivo_path", "versao_id", "em", "ate")).select("versao_id")


_CUR = "cur AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lei_id, dispositivo_path ORDER BY (ate IS NULL) DESC, em DESC, versao_id DESC) AS rn FROM versoes) WHERE rn = 1)"


@query("jn4_tree_roots", V + f", {_CUR} SELECT c.versao_id, c.dispositivo_parent_path AS parent, p.dispositivo_path IS NULL AS is_root FROM cur c LEFT JOIN cur p ON c.lei_id = p.lei_id AND c.dispositivo_parent_path = p.dispositivo_path")
def _(spark, d):
    v = norm_versions(spark, d).select("lei_id", "dispositivo_path", "dispositivo_parent_path", "versao_id", "em", "ate")
    return provisions.tree(v).select("versao_id", F.col("dispositivo_parent_path").alias("parent"), "is_root")


@query("srt6_tree_order", f"WITH RECURSIVE {CTE}, {_CUR}, n AS (SELECT c.*, p.dispositivo_path IS NULL AS is_root FROM cur c LEFT JOIN cur p ON c.lei_id = p.lei_id AND c.dispositivo_parent_path = p.dispositivo_path)," + """
t AS (SELECT lei_id, dispositivo_path, 0 AS depth, printf('%08d:%s', dispositivo_ordem, dispositivo_path) AS sort_key FROM n WHERE is_root
  UNION ALL SELECT n.lei_id, n.dispositivo_path, t.depth + 1, t.sort_key || '/' || printf('%08d:%s', n.dispositivo_ordem, n.dispositivo_path) FROM n JOIN t ON n.lei_id = t.lei_id AND n.dispositivo_parent_path = t.dispositivo_path AND NOT n.is_root)
SELECT * FROM t""")
def _(spark, d):
    v = norm_versions(spark, d).select("lei_id", "dispositivo_path", "dispositivo_parent_path", "dispositivo_ordem", "versao_id", "em", "ate")
    return provisions.ordered_tree(v).select("lei_id", "dispositivo_path", "depth", "sort_key")


@query("agg14_history", V + "SELECT lei_id, dispositivo_path, min(dispositivo_ordem) AS ordem, count(*) AS versoes, string_agg(versao_id, ';' ORDER BY em, versao_id) AS ids FROM versoes GROUP BY 1, 2 HAVING count(*) > 1 OR bool_or(ate IS NOT NULL OR alterado_por IS NOT NULL)")
def _(spark, d):
    return provisions.history(norm_versions(spark, d)).withColumn("ids", F.array_join("ids", ";"))


@query("agg13_evidence", V + """, f AS (SELECT lei_id, versao_id, i AS pos, x->>'ia_id' AS ia_id, CAST(x->>'diverge' AS BOOLEAN) AS diverge, x->>'texto_divergente' AS t FROM (
  SELECT lei_id, versao_id, generate_subscripts(l, 1) AS i, unnest(l) AS x FROM (SELECT lei_id, versao_id, CAST(fontes AS JSON[]) AS l FROM versoes))),
t AS (SELECT lei_id, ia_id, t, min(versao_id || lpad(CAST(pos AS VARCHAR), 4, '0')) AS seen_at FROM f WHERE t <> '' GROUP BY 1, 2, 3)
SELECT s.*, coalesce((SELECT string_agg(t, ';' ORDER BY seen_at) FROM t WHERE t.lei_id = s.lei_id AND t.ia_id = s.ia_id), '') AS textos
FROM (SELECT lei_id, ia_id, bool_or(diverge) AS diverge, count(*) AS mencoes FROM f GROUP BY 1, 2) s""")
def _(spark, d):
    return provisions.evidence(norm_versions(spark, d)).withColumn("textos", F.array_join("textos", ";"))


@query("agg16_sources_per_version", V + "SELECT versao_id, num_fontes AS n, tem_divergencia AS diverge FROM versoes")
def _(spark, d):
    f = law.sources(F.col("fontes"))
    return norm_versions(spark, d).select("versao_id", F.size(f).alias("n"), F.exists(f, lambda x: x["diverge"]).alias("diverge"))


@query("agg15_kind_labels", V + """SELECT rotulo, string_agg(tipo_lei, ';' ORDER BY tipo_lei) AS tipos FROM (SELECT DISTINCT tipo_lei, CASE tipo_lei WHEN 'lei' THEN 'Lei Ordinária' WHEN 'lei.complementar' THEN 'Lei Complementar' WHEN 'lc' THEN 'Lei Complementar'
  WHEN 'decreto' THEN 'Decreto' WHEN 'resolucao' THEN 'Resolução' ELSE 'Desconhecido' END AS rotulo FROM versoes) GROUP BY 1""")
def _(spark, d):
    kinds = norm_versions(spark, d).select("tipo_lei").distinct()
    return kinds.groupBy(law.kind_label(F.col("tipo_lei")).alias("rotulo")).agg(F.array_join(F.sort_array(F.collect_list("tipo_lei")), ";").alias("tipos"))


@query("agg23_law_divergence", V + "SELECT lei_id, bool_or(tem_divergencia) AS diverge, CAST(sum(num_fontes) AS BIGINT) AS fontes FROM versoes GROUP BY 1")
def _(spark, d):
    return norm_versions(spark, d).groupBy("lei_id").agg(F.bool_or("tem_divergencia").alias("diverge"), F.sum("num_fontes").alias("fontes"))


@query("snk13_export_rows", V + f"SELECT {', '.join(c for c in EXPORT_COLUMNS)} FROM versoes WHERE ate IS NULL")
def _(spark, d):
    return norm_versions(spark, d).where("ate IS NULL").select(*EXPORT_COLUMNS)


@query("law_dates_and_ids", V + "SELECT versao_id, lei_id || '#' || dispositivo_path || '#' || coalesce(strftime(em, '%Y-%m-%d'), 'unknown') AS id, coalesce(strftime(ate, '%d/%m/%Y'), '—') AS fim, strftime(em, '%Y-%m-%d') AS iso, coalesce(epoch_ms(CAST(data_publicacao AS TIMESTAMP)), 0) AS ms FROM versoes")
def _(spark, d):
    c = F.col
    return norm_versions(spark, d).select("versao_id", law.version_id(c("lei_id"), c("dispositivo_path"), c("em")).alias("id"), law.format_date(c("ate")).alias("fim"), law.iso_date(c("em")).alias("iso"), law.date_ms(c("data_publicacao")).alias("ms"))


@query("law2_urn_parts", V + """SELECT versao_id, nullif(regexp_extract(urn_lex_lei, '^urn:lex:br((?:;[a-z][a-z0-9._]*)*):', 1), '') AS locais, nullif(regexp_extract(urn_lex_lei, ':(\\d{4}-\\d{2}-\\d{2});([0-9]+)$', 2), '') AS numero,
  TRY_CAST(nullif(regexp_extract(urn_lex_lei, ':(\\d{4}-\\d{2}-\\d{2});', 1), '') AS DATE) AS publicada FROM (SELECT versao_id, replace(urn_lex_lei, '_', '') AS urn_lex_lei FROM versoes)""")
def _(spark, d):
    urn = F.regexp_replace("urn_lex_lei", "_", "")
    return norm_versions(spark, d).select("versao_id", law.urn_part(urn, "locais").alias("locais"), law.urn_part(urn, "numero").alias("numero"), law.publication_date(urn).alias("publicada"))


@query("law1_path_kind", V + "SELECT DISTINCT dispositivo_path AS path, dispositivo_tipo AS tipo FROM versoes")
def _(spark, d):
    return norm_versions(spark, d).select(F.col("dispositivo_path").alias("path")).distinct().withColumn("tipo", law.path_kind(F.col("path")))


@query("law10_titles", V + """SELECT DISTINCT lei_id, CASE tipo_lei WHEN 'lei' THEN 'Lei Ordinária' WHEN 'lei.complementar' THEN 'Lei Complementar' WHEN 'lc' THEN 'Lei Complementar'
  WHEN 'decreto' THEN 'Decreto' WHEN 'resolucao' THEN 'Resolução' ELSE 'Desconhecido' END || ' nº ' || numero_lei || '/' || ano_lei AS titulo, upper(ente) AS lugar, '/lei?id=' || lei_id AS url FROM versoes""")
def _(spark, d):
    c = F.col
    return norm_versions(spark, d).select("lei_id", law.law_title(c("tipo_lei"), c("numero_lei"), c("ano_lei")).alias("titulo"), law.place_label(c("ente")).alias("lugar"), law.law_url(c("lei_id")).alias("url")).distinct()


@query("law14_breadcrumbs", V + """SELECT DISTINCT dispositivo_path AS path, CASE dispositivo_path WHEN 'ementa' THEN 'Ementa' WHEN 'art-1' THEN 'Art. 1º' WHEN 'art-1-par-1' THEN 'Art. 1º › § 1º' WHEN 'art-1-par-2' THEN 'Art. 1º › § 2º'
  WHEN 'art-2' THEN 'Art. 2º' WHEN 'art-2-inc-1' THEN 'Art. 2º › I' ELSE 'Art. 2º › I › a)' END AS trilha FROM versoes""")
def _(spark, d):
    return norm_versions(spark, d).select(F.col("dispositivo_path").alias("path")).distinct().withColumn("trilha", law.breadcrumb(F.col("path")))


@query("set6_unique_versions", V + "SELECT versao_id, count(*) AS n FROM (SELECT versao_id FROM versoes UNION ALL SELECT versao_id FROM versoes WHERE num_fontes = 2) GROUP BY 1 HAVING count(*) > 1")
def _(spark, d):
    """Two sets of laws put together: the ids that both have."""
    v = norm_versions(spark, d)
    return quality.repeated(v.select("versao_id").union(v.where("num_fontes = 2").select("versao_id")), "versao_id")


@query("val7_increasing_dates", V + "SELECT lei_id AS file, 'VAL7' AS rule, dispositivo_path || '#' || CAST(em AS VARCHAR) AS message FROM (SELECT *, lag(em) OVER (PARTITION BY lei_id, dispositivo_path ORDER BY num_fontes || versao_id) AS before FROM versoes) WHERE em <= before")
def _(spark, d):
    return quality.increasing(norm_versions(spark, d).withColumn("pos", F.concat(F.col("num_fontes").cast("string"), "versao_id")))


@query("jn15_provenance", V + """, f AS (SELECT versao_id, unnest(CAST(fontes AS JSON[])) AS x FROM versoes), k AS (SELECT versao_id, CAST(regexp_extract(x->>'ia_id', '(\\d+)$', 1) AS BIGINT) AS sk FROM f)
SELECT versao_id, s_suppkey, s_name, n_name FROM k JOIN supplier ON sk = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey""")
def _(spark, d):
    k = norm_versions(spark, d).select("versao_id", F.explode(law.sources(F.col("fontes"))).alias("f")).select("versao_id", F.regexp_extract("f.ia_id", r"(\d+)$", 1).cast("bigint").alias("s_suppkey"))
    s, n = table(spark, d, "supplier"), table(spark, d, "nation")
    return k.join(s, "s_suppkey").join(n, s["s_nationkey"] == n["n_nationkey"], "left").select("versao_id", "s_suppkey", "s_name", "n_name")


@query("fig_schema", V + " UNION ALL ".join(f"SELECT '{f.name}' AS name, count({f.name}) AS filled FROM versoes" for f in VERSIONS))
def _(spark, d):
    """The view has the schema's columns, and how many rows fill each."""
    v = norm_versions(spark, d)
    if [(f.name, f.dataType) for f in v.schema] != [(f.name, f.dataType) for f in VERSIONS]:
        raise ValueError("the versions view differs from its schema")
    filled = v.agg(*[F.count(f.name).alias(f.name) for f in VERSIONS])
    return filled.select(F.explode(F.array(*[F.struct(F.lit(f.name).alias("name"), F.col(f.name).alias("filled")) for f in VERSIONS])).alias("r")).select("r.*")
