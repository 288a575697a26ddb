"""Current wordings, provision trees, histories and evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from normalake.functions.law import date_ms, sources
from normalake.sources.tables import dropped, stored


def current(df: DataFrame) -> DataFrame:
    """Each provision's wording: one in force before one ended, then the
    latest start (none counts as 1970), then the later row. An aggregation
    with map-side combination."""
    key = F.struct(F.col("ate").isNull(), date_ms(F.col("em")), F.col("versao_id"))
    return df.groupBy("lei_id", "dispositivo_path").agg(F.max_by(F.struct(*df.columns), key).alias("r")).select("r.*")


def tree(df: DataFrame) -> DataFrame:
    """Current provisions with is_root: no parent, itself, or one not there."""
    now = current(df)
    parents = now.select(F.col("lei_id").alias("_l"), F.col("dispositivo_path").alias("_p"))
    met = (F.col("lei_id") == F.col("_l")) & (F.col("dispositivo_parent_path") == F.col("_p")) & (F.col("dispositivo_parent_path") != F.col("dispositivo_path"))
    return now.join(parents, met, "left").withColumn("is_root", F.col("_p").isNull()).drop("_l", "_p")


def sibling_ranks(nodes: DataFrame, locale: str) -> DataFrame:
    """nodes (lei_id, dispositivo_parent_path, dispositivo_ordem,
    dispositivo_path) with rank, a provision's place among its siblings from 1:
    by order (none comes last), then by path as the locale sorts it, where case
    and accents part only what is else the same, then by code points. Digits
    are characters, so art-10 comes before art-2 there as well."""
    path = F.collate("dispositivo_path", locale)
    by = Window.partitionBy("lei_id", "dispositivo_parent_path").orderBy(F.col("dispositivo_ordem").asc_nulls_last(), path, "dispositivo_path")
    return nodes.withColumn("rank", F.row_number().over(by))


def ordered_tree(df: DataFrame, locale: str | None = None) -> DataFrame:
    """tree() with depth and a sort key that puts siblings by order and path,
    paths by code points or as a locale sorts them.
    Levels are joined from the roots down until one is empty, whatever the
    depth. Provisions on a cycle of parents, and what hangs on one, no root
    reaches: they come with a null depth and sort key."""
    step = F.format_string("%08d:%s", F.coalesce("dispositivo_ordem", F.lit(99_999_999)), "dispositivo_path")
    whole = tree(df)
    if locale:
        top = F.when(F.col("is_root"), F.lit(None).cast("string")).otherwise(F.col("dispositivo_parent_path"))
        ranked = sibling_ranks(whole.withColumn("_parent", F.col("dispositivo_parent_path")).withColumn("dispositivo_parent_path", top), locale)
        whole, step = ranked.withColumn("dispositivo_parent_path", F.col("_parent")), F.format_string("%08d", "rank")
    nodes = stored(whole.withColumn("_step", step).drop("rank", "_parent"))
    below = nodes.where("NOT is_root")
    level = stored(nodes.where("is_root").withColumn("depth", F.lit(0)).withColumn("sort_key", F.col("_step")))
    out, levels, depth = level, [level], 0
    while True:
        above = level.select(F.col("lei_id").alias("_l"), F.col("dispositivo_path").alias("_p"), F.col("sort_key").alias("_k"))
        under = (F.col("lei_id") == F.col("_l")) & (F.col("dispositivo_parent_path") == F.col("_p"))
        depth += 1
        level = stored(below.join(above, under).withColumn("depth", F.lit(depth)).withColumn("sort_key", F.concat("_k", F.lit("/"), "_step")).drop("_l", "_p", "_k"))
        if not level.take(1):
            dropped(level)
            break
        levels.append(level)
        out = out.unionByName(level)
    lost = nodes.join(out.select("lei_id", "dispositivo_path"), ["lei_id", "dispositivo_path"], "left_anti").select(*nodes.columns, F.lit(None).cast("int").alias("depth"), F.lit(None).cast("string").alias("sort_key"))
    whole = stored(out.unionByName(lost).drop("_step"))
    dropped(nodes, *levels)
    return whole


def history(df: DataFrame) -> DataFrame:
    """Provisions with more than one wording, or one ended or amended, and
    their wordings from the earliest; provisions by the order and path of their
    first wording."""
    item = F.struct(date_ms(F.col("em")).alias("ms"), F.col("versao_id"))
    order = F.coalesce(F.min_by("dispositivo_ordem", F.struct(date_ms(F.col("em")), "versao_id")), F.lit(2**31 - 1))
    groups = df.groupBy("lei_id", "dispositivo_path").agg(F.count("*").alias("versoes"), F.bool_or(F.col("ate").isNotNull() | F.col("alterado_por").isNotNull()).alias("mudou"), F.min("dispositivo_ordem").alias("ordem"), order.alias("_at"), F.sort_array(F.collect_list(item)).alias("itens"))
    listed = groups.where("versoes > 1 OR mudou").orderBy("lei_id", "_at", "dispositivo_path")
    return listed.select("lei_id", "dispositivo_path", "ordem", "versoes", F.transform("itens", lambda x: x["versao_id"]).alias("ids"))


def evidence(df: DataFrame) -> DataFrame:
    """Each norm's sources: whether one diverges, and the texts that do, first
    seen first. Mentions are counted by text before they come together."""
    rows = df.select("lei_id", "versao_id", F.posexplode(sources(F.col("fontes"))).alias("pos", "f")).select("lei_id", "versao_id", "pos", "f.*")
    each = rows.groupBy("lei_id", "ia_id", F.nullif("texto_divergente", F.lit("")).alias("texto")).agg(F.bool_or("diverge").alias("diverge"), F.count("*").alias("n"), F.min(F.struct("versao_id", "pos")).alias("at"))
    listed = F.sort_array(F.collect_list(F.when(F.col("texto").isNotNull(), F.struct("at", "texto"))))
    return each.groupBy("lei_id", "ia_id").agg(F.bool_or("diverge").alias("diverge"), F.sum("n").alias("mencoes"), F.transform(listed, lambda x: x["texto"]).alias("textos"))


def end_dates(df: DataFrame) -> DataFrame:
    """Versions (lei_id, dispositivo_path, pos, em, own_end, ancestor_end,
    law_end) with ate: the next wording's start even if that is null, else the
    own, an ancestor's, the law's revocation."""
    w = Window.partitionBy("lei_id", "dispositivo_path").orderBy("pos")
    more = F.lead(F.lit(True)).over(w).isNotNull()
    return df.withColumn("ate", F.when(more, F.lead("em").over(w)).otherwise(F.coalesce("own_end", "ancestor_end", "law_end")))


def sibling_order(df: DataFrame, *order: str) -> DataFrame:
    """ordem: the place among the rows of the same parent, from 0."""
    w = Window.partitionBy("lei_id", "dispositivo_parent_path").orderBy(*order)
    return df.withColumn("ordem", (F.row_number().over(w) - 1).cast("bigint"))


def nearest_ancestor(df: DataFrame, value: str) -> DataFrame:
    """inherited: the value of the nearest ancestor that has one, by provision
    (lei_id, path, parent). Each round looks twice as far up as the last, so a
    tree of any depth takes the logarithm of its depth; a cycle without a value
    gives null and ends the search when no tree can be deeper."""
    own = df.select("lei_id", "path", "parent", F.col(value).alias("_v"))
    now = stored(own.join(own.select("lei_id", F.col("path").alias("parent"), F.col("_v").alias("_found"), F.lit(True).alias("_there")), ["lei_id", "parent"], "left").select("lei_id", "path", F.when(F.col("_there"), F.col("parent")).alias("_up"), "_found"))
    reach, most = 1, now.count()
    while reach <= most and now.where("_found IS NULL AND _up IS NOT NULL").take(1):
        far = now.select("lei_id", F.col("path").alias("_up"), F.col("_up").alias("_next"), F.col("_found").alias("_more"))
        last, now = now, stored(now.join(far, ["lei_id", "_up"], "left").select("lei_id", "path", F.col("_next").alias("_up"), F.coalesce("_found", "_more").alias("_found")))
        dropped(last)
        reach *= 2
    return df.join(now.select("lei_id", "path", F.col("_found").alias("inherited")), ["lei_id", "path"]).select(*df.columns, "inherited")
