"""Sharding: contiguous shards of near-equal bytes from global prefix sums.

Method, with DataFrame operations only: rows get a range partition by doc_id;
each partition's totals (one row a partition) give every partition its offset;
inside a partition a running sum finishes the prefix sum.  A row belongs to the
shard in which the middle of its bytes falls, so shards are contiguous in
doc_id order and differ from the target by less than the largest text.

Only ids, sizes and checksums move; texts are read once and stay where they
are.  What is broadcast has one row for each partition or shard.

Defined cases: a null text has size 1 and the checksum of no bytes.  A null
doc_id comes first.  Repeated ids are ordered by size and checksum; rows equal
in all three are interchangeable.  An empty table gives no rows.  Groups of
equal texts may span shards, as one group may exceed a shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from normalake.sources.tables import stored

SHARDS, RANGE_ROWS = 8, 500_000


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """docs (doc_id, text) -> doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    # the row number spreads equal rows over ranges
    slim = slim.withColumn("tie", F.monotonically_increasing_id())
    order = ["doc_id", "size", "text_crc32", "tie"]
    # a range's rows are sorted in one task, so their number is bounded
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // RANGE_ROWS))
    ranged = stored(slim.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()))
    totals = ranged.groupBy("part").agg(F.sum("size").alias("part_size"), F.count("*").alias("part_rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select("part", F.coalesce(F.sum("part_size").over(before), F.lit(0)).alias("size_before"), F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("rows_before"), F.sum("part_size").over(whole).alias("total"))
    inside = Window.partitionBy("part").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.select("part", *order, F.sum("size").over(upto).alias("upto"), F.row_number().over(inside).alias("rank"))
    placed = placed.join(F.broadcast(offsets), "part")  # one row for each partition
    shard = F.expr(f"CAST(least({shards - 1}, ({shards}L * (2L * (size_before + upto) - size)) div (2L * total)) AS INT)")
    placed = placed.select("doc_id", "size", "text_crc32", shard.alias("shard"), (F.col("rows_before") + F.col("rank") - 1).alias("at"))
    first = placed.groupBy("shard").agg(F.min("at").alias("shard_start"))
    out = placed.join(F.broadcast(first), "shard")  # one row for each shard
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("at") - F.col("shard_start")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
