"""Search and listing over the versions table."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from normalake.functions.text import like_pattern

PAGE_SIZE, PAGE_MOST = 20, 100
#: Where one norm's row is chosen: the summary, else the first provision.
_TIES = ["dispositivo_ordem", "dispositivo_path", "versao_id"]


def predicates(term: str = "", ente: str | None = None, kinds=None, year: int | None = None) -> Column:
    """Wordings in force; what is absent or empty filters nothing."""
    found = [F.col("ate").isNull()]
    if term.strip():
        found.append(F.col("texto_normalizado").ilike(like_pattern(term.strip())))
    if ente:
        found.append(F.col("ente") == ente)
    kinds = [k for k in ([kinds] if isinstance(kinds, str) else kinds or []) if k]
    if kinds:
        found.append(F.col("tipo_lei").isin(*kinds))
    if year is not None and year > 0:
        found.append(F.year("em") == year)
    return reduce(lambda a, b: a & b, found)


def valid_year(given: str) -> int | None:
    """A year from 1900 to 2099, else None, which filters nothing."""
    return int(given) if given.isdecimal() and 1900 <= int(given[:9]) <= 2099 and len(given) < 10 else None


def clamp(page: float = 0, size: float = PAGE_SIZE) -> tuple[int, int]:
    """Row limit and offset of a page."""
    size = min(PAGE_MOST, max(1, math.trunc(size))) if math.isfinite(size) else PAGE_SIZE
    return size, (max(0, math.trunc(page)) if math.isfinite(page) else 0) * size


def _paged(df: DataFrame, order: list, page: float, size: float) -> DataFrame:
    limit, offset = clamp(page, size)
    return df.orderBy(*order).offset(offset).limit(limit)


def representative(df: DataFrame) -> DataFrame:
    """One row for each norm: its summary, else its first provision; nulls come
    last. An aggregation with map-side combination, not a window."""
    other = ~F.coalesce(F.col("dispositivo_path") == "ementa", F.lit(False))
    key = F.struct(other, *[x for c in _TIES for x in (F.col(c).isNull(), F.col(c))])
    return df.groupBy("lei_id").agg(F.min_by(F.struct(*df.columns), key).alias("r")).select("r.*")


def search(df: DataFrame, term: str = "", page: float = 0, size: float = PAGE_SIZE, **filters) -> DataFrame:
    """Provisions that match, or without a term one row for each norm."""
    found = df.where(predicates(term, **filters))
    if term.strip():
        return _paged(found, ["lei_id", "dispositivo_path", "versao_id"], page, size)
    return _paged(representative(found), ["lei_id"], page, size)


def count(df: DataFrame, term: str = "", **filters) -> DataFrame:
    found = df.where(predicates(term, **filters))
    return found.agg((F.count("*") if term.strip() else F.countDistinct("lei_id")).cast("bigint").alias("cnt"))


def grouped(df: DataFrame, term: str = "", page: float = 0, size: float = PAGE_SIZE, **filters) -> DataFrame:
    """Each norm's first matching provision with the number of matches.

    An aggregation with map-side combination: the first row is the minimum by
    the sort keys, so no norm's rows are gathered and sorted as in a window."""
    if not term.strip():
        return search(df, "", page, size, **filters).withColumn("match_count", F.lit(0))
    found = df.where(predicates(term, **filters))
    key = F.struct(F.coalesce("dispositivo_ordem", F.lit(2**31 - 1)), F.col("dispositivo_path"), F.col("versao_id"))
    one = found.groupBy("lei_id").agg(F.min_by(F.struct(*df.columns), key).alias("r"), F.count("*").cast("int").alias("match_count"))
    return _paged(one.select("r.*", "match_count"), ["lei_id"], page, size)


def count_grouped(df: DataFrame, term: str, **filters) -> DataFrame:
    return df.where(predicates(term, **filters)).agg(F.countDistinct("lei_id").cast("bigint").alias("cnt"))


def known_kinds(df: DataFrame) -> DataFrame:
    return df.where(F.col("tipo_lei").isNotNull() & (F.col("tipo_lei") != "desconhecido")).select("tipo_lei").distinct().orderBy("tipo_lei")


def places(df: DataFrame) -> DataFrame:
    return df.where(F.coalesce("ente", F.lit("")) != "").select("ente").distinct().orderBy("ente")


def recent(df: DataFrame, limit: float = 8) -> DataFrame:
    """The latest laws; a limit that is no finite number counts as 8."""
    n = min(50, max(1, math.trunc(limit))) if math.isfinite(limit) else 8
    return representative(df.where("ate IS NULL")).orderBy(F.col("data_publicacao").desc_nulls_last(), F.col("ano_lei").desc_nulls_last(), F.col("lei_id").desc()).limit(n)


def law_rows(df: DataFrame, law: str) -> DataFrame:
    return df.where(F.col("lei_id") == law).orderBy(F.col("dispositivo_ordem").asc_nulls_last(), "dispositivo_path", F.col("em").asc_nulls_last())


def as_of(df: DataFrame, day: str, with_revoked_later: bool = False) -> DataFrame:
    """Wordings in force on a day. The documented recipe also drops provisions
    revoked after it; with_revoked_later keeps them."""
    d = F.lit(day).cast("date")
    found = (F.col("em") <= d) & (F.col("ate").isNull() | (F.col("ate") > d))
    return df.where(found if with_revoked_later else found & ~F.col("dispositivo_revogado"))


def total_pages(counted: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    return counted.select(F.greatest(F.lit(1), F.ceil(F.col("cnt") / size)).cast("bigint").alias("pages"))
