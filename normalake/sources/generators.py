"""Candidate URLs and keys from number ranges and templates."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from normalake.functions.identity import year_segment

# File-name heads and labels of the state portal's kinds.
PORTAL_KINDS = {"lei": ("L", "Lei"), "lc": ("LC", "Lei Complementar"), "decreto": ("D", "Decreto"), "decreto-lei": ("DL", "Decreto-Lei"), "ec": ("EC", "Emenda Constitucional"), "resolucao": ("Res", "Resolução"), "portaria": ("Port", "Portaria")}

# A federal kind's folder in a year, how its files begin, and its old address.
FEDERAL_KINDS = {
    "lei": ("lei", "l", "leis/L%d.htm"), "lcp": ("lei", "lcp", "leis/lcp/Lcp%d.htm"), "decreto": ("decreto", "d", "decreto/D%d.htm"),
    "decreto-lei": ("decreto-lei", "del", "Decreto-Lei/Del%d.htm"), "emc": ("Emenda", "emc", "Constituicao/Emendas/Emc/emc%02d.htm"), "mpv": ("Mpv", "mpv", "MPV/Antigas_2001/%d.htm"),
}


def numbers(spark: SparkSession, start: int, end: int) -> DataFrame:
    return spark.range(start, end + 1).withColumnRenamed("id", "num") if end >= start else spark.range(0).withColumnRenamed("id", "num")


def sequential(spark: SparkSession, templates: list[str], start: int, end: int, known: DataFrame | None = None) -> DataFrame:
    """Every number in every template ({num}), less the known urls. Templates
    are a short list in the plan, not a table."""
    each = F.explode(F.array(*[F.lit(t) for t in templates]))
    out = numbers(spark, start, end).select("num", each.alias("template")).withColumn("url", F.replace("template", F.lit("{num}"), F.col("num").cast("string")))
    return out.join(known.select("url").distinct(), "url", "left_anti") if known is not None else out


def state_portal(spark: SparkSession, kind: str, start: int, end: int, base: str, prefix: str | None = None, place: str = "Rondônia") -> DataFrame:
    """A prefix of file names admits kinds that are not known."""
    if kind not in PORTAL_KINDS and prefix is None:
        raise ValueError(f"unknown kind: {kind}")
    head, label = PORTAL_KINDS.get(kind, (None, kind.capitalize()))
    head, n = prefix if prefix is not None else head, F.col("num")
    return numbers(spark, start, end).select(F.format_string("%s-%05d", F.lit(kind), n).alias("chave"), F.format_string("%s nº %d (%s)", F.lit(label), n, F.lit(place)).alias("titulo"), F.format_string("%s%s%d.pdf", F.lit(base), F.lit(head), n).alias("url"))


def _federal_url(base: str, kind: str) -> Column:
    if kind not in FEDERAL_KINDS:
        raise ValueError(f"unknown kind: {kind}")
    folder, head, old = FEDERAL_KINDS[kind]
    segment = year_segment(F.col("year"))
    new = F.format_string(f"%s_ato%s/%d/{folder}/{head}%d.htm", F.lit(base), segment, F.col("year"), F.col("num"))
    return F.when(segment.isNotNull(), new).otherwise(F.format_string(f"%s{old}", F.lit(base), F.col("num")))


def federal(numbered: DataFrame, years: DataFrame, base: str, kind: str = "lei") -> DataFrame:
    """numbered (num), years (num, year): from 2003 the folder of the year and
    kind, before it or without a year the kind's old address."""
    return federal_kinds(numbered, years, base, [kind]).drop("kind")


def federal_kinds(numbered: DataFrame, years: DataFrame, base: str, kinds: list[str]) -> DataFrame:
    """federal() of several kinds, with the kind: the years are joined once."""
    each = F.array(*[F.struct(F.lit(k).alias("kind"), _federal_url(base, k).alias("url")) for k in kinds])
    # numbers compress so well that files seem small: years sent whole to each task would not fit
    met = numbered.join(years.hint("merge"), "num", "left")
    return met.select("num", "year", F.explode(each).alias("k")).select("k.kind", "num", "year", "k.url")


def parse_all(spark: SparkSession, kind: str, start: int, end: int) -> DataFrame:
    return numbers(spark, start, end).select(F.format_string("%s-%05d", F.lit(kind), F.col("num")).alias("chave"))


def highest(archived: DataFrame, templates: list[str]) -> DataFrame:
    """archived (url) -> template, numero: the largest number that stands for
    {num} in each template, else 0; numbers beyond a long are passed over. One
    pass serves all templates."""
    pattern = lambda t: "^" + r"(\d+)".join(re.escape(x) for x in t.split("{num}", 1)) + "$"
    most = [F.max(F.nullif(F.regexp_extract("url", pattern(t), 1), F.lit("")).try_cast("bigint")).alias(f"_{i}") for i, t in enumerate(templates)]
    rows = [F.struct(F.lit(t).alias("template"), F.coalesce(F.col(f"_{i}"), F.lit(0)).cast("bigint").alias("numero")) for i, t in enumerate(templates)]
    return archived.agg(*most).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
