"""Counts over the versions and staging tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _provision() -> Column:
    return F.concat("lei_id", F.lit("|"), "dispositivo_path")


def stats(df: DataFrame) -> DataFrame:
    return df.agg(
        F.countDistinct("lei_id").alias("leis"), F.countDistinct(_provision()).alias("dispositivos"), F.count("*").alias("versoes"),
        F.countDistinct(F.when(F.col("lei_revogada"), F.col("lei_id"))).alias("leis_revogadas"), F.countDistinct(F.when(F.col("tem_divergencia"), F.col("lei_id"))).alias("leis_com_divergencia"),
        F.min("ano_lei").cast("int").alias("ano_min"), F.max("ano_lei").cast("int").alias("ano_max"), F.max("vigente_em").alias("vigente_em_max"),
    )


def by_place(df: DataFrame) -> DataFrame:
    return df.groupBy("ente").agg(F.countDistinct("lei_id").alias("leis"), F.countDistinct(_provision()).alias("dispositivos"), F.min("ano_lei").cast("int").alias("ano_min"), F.max("ano_lei").cast("int").alias("ano_max")).orderBy("ente")


def contents(df: DataFrame, law: str) -> DataFrame:
    """A norm's distinct provisions in order."""
    return df.where(F.col("lei_id") == law).select("dispositivo_path", "dispositivo_tipo", "dispositivo_parent_path", "dispositivo_ordem").distinct().orderBy("dispositivo_ordem", "dispositivo_path")


def count_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("total")).orderBy(F.desc("total"), column)


def newest_years(df: DataFrame, n: int = 10) -> DataFrame:
    return df.where(F.col("ano").isNotNull()).groupBy("ano").agg(F.count("*").alias("total")).orderBy(F.desc("ano")).limit(n)
