"""Seeded samples by source and the annotation pool."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def per_source(rows: DataFrame, source: str, key: str, n: int, floor: int = 0, cap: int | None = None, seed: int = 42) -> DataFrame:
    """Equally many of each source, the same ones for a seed."""
    wanted = max(n, floor) if cap is None else min(max(n, floor), cap)
    # md5 is at hand in every SQL engine, so the draw can be checked elsewhere
    draw = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    w = Window.partitionBy(source).orderBy(draw, key)
    return rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= wanted).drop("_rn")


def pool_manifest(rows: DataFrame, picked: DataFrame, source: str, key: str, text: str, least: int = 200) -> DataFrame:
    """By source: available, picked, kept (long enough), skipped."""
    chosen = picked.select(F.col(key).alias("_k"))
    met = rows.join(chosen, rows[key] == chosen["_k"], "left")
    taken, long = F.col("_k").isNotNull(), F.length(text) >= least
    return met.groupBy(source).agg(F.count("*").alias("available"), F.count_if(taken).alias("picked"), F.count_if(taken & F.coalesce(long, F.lit(False))).alias("kept"), F.count_if(taken & ~F.coalesce(long, F.lit(False))).alias("skipped"))
