"""Incremental runs as Structured Streaming.

The stateful steps are ordinary streaming aggregations, so state is split by
key and kept in the state store; a run takes what is there (availableNow) and
the next resumes from its checkpoint.  The replay functions drive a table
through such a run and return the sink.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from normalake.operators import ledger
from normalake.sources.tables import shared_folder


def source(spark: SparkSession, path: str, files: int | None = None) -> DataFrame:
    """A stream of the Parquet files at path."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    head, _, last = path.rstrip("/").rpartition("/")
    return reader.option("pathGlobFilter", last).parquet(head) if last.endswith(".parquet") else reader.parquet(path)


def latest_by(stream: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Newest wins: attempts and the last value of each key."""
    return stream.groupBy(F.col(key).alias("url")).agg(F.count("*").alias("tentativas"), F.max_by(value, F.struct(order, value)).alias("ultima"))


def states(stream: DataFrame, order: list[str]) -> DataFrame:
    """A log (url, status, snapshot, and the columns of order) to the ledger's
    state of each url. A row without a status registers the url, the first one
    counts; it is pending until a row with a status updates it (downloaded,
    bundled, failed, or pending again), the last one counts. The last snapshot
    that an update carries stays. Updates before the registration, or without
    one, are of no row and change nothing."""
    at = F.struct(*order)
    born = F.min(F.when(F.col("status").isNull(), at))
    last = F.max(F.when(F.col("status").isNotNull(), F.struct(at.alias("at"), "status")))
    seen = F.max(F.when(F.col("status").isNotNull() & F.col("snapshot").isNotNull(), F.struct(at.alias("at"), "snapshot")))
    each = stream.groupBy("url").agg(born.alias("born"), last.alias("last"), seen.alias("seen"))
    known = F.col("last.at") > F.col("born")
    out = each.where("born IS NOT NULL").select("url", F.when(known, F.col("last.status")).otherwise("pending").alias("status"), F.when(F.col("seen.at") > F.col("born"), F.col("seen.snapshot")).alias("snapshot"), F.when(known, F.col(f"last.at.{order[0]}")).alias("ultima_tentativa"))
    return out


def first_seen(stream: DataFrame, key: str) -> DataFrame:
    return stream.select(key).dropDuplicates([key])


def tumbling(stream: DataFrame, every: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Counts by window and type; beyond the reference's own operators."""
    return stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(F.window("ts", every), "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").alias("day"), "event_type", "n")


#: Parts of a ledger by hash of the key.
BUCKETS = 64


def upsert_batches(stream: DataFrame, path: str, key: str, order: str, checkpoint: str):
    """Insert-or-ignore of each batch into the Parquet ledger at path: keys
    there stay, new ones are appended. The ledger lies in folders by a hash of
    the key, and a batch reads the folders its keys are in. A batch that is run
    again appends nothing twice, as its keys are there by then."""
    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("_bucket", bucket)
        first = rows.groupBy(key).agg(F.min_by(F.struct(*rows.columns), order).alias("r")).select("r.*")
        met = [r[0] for r in first.select("_bucket").distinct().collect()]  # BUCKETS at most
        try:
            old = spark.read.schema(rows.schema).parquet(path).where(F.col("_bucket").isin(met))
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            old = spark.createDataFrame([], rows.schema)
        new = ledger.skip_existing(first, old.select(key), key)
        new.repartition(F.col("_bucket")).write.mode("append").partitionBy("_bucket").parquet(path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ledger_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a ledger that upsert_batches() keeps."""
    return spark.read.parquet(path).drop("_bucket")


def _checkpoint(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"


def _run(spark: SparkSession, out: DataFrame, mode: str) -> DataFrame:
    where = _checkpoint(spark)
    kept: dict[str, DataFrame] = {}

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{where}/out/{number}")
        kept["last"] = number

    query = out.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{where}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    if "last" not in kept:
        return spark.createDataFrame([], out.schema)
    return spark.read.parquet(f"{where}/out/{kept['last']}" if mode == "complete" else f"{where}/out/*")


def replay(spark: SparkSession, path: str, step: Callable[[DataFrame], DataFrame], mode: str) -> DataFrame:
    return _run(spark, step(source(spark, path)), mode)


def replay_latest(spark: SparkSession, path: str) -> DataFrame:
    return replay(spark, path, lambda s: s.groupBy(F.col("event_type").alias("url")).agg(F.count("*").alias("tentativas"), F.max_by("event_id", F.struct("ts", "event_id")).alias("ultima")), "complete")


def replay_distinct(spark: SparkSession, path: str, key: str) -> DataFrame:
    return replay(spark, path, lambda s: first_seen(s, key), "append")


def replay_tumbling(spark: SparkSession, path: str) -> DataFrame:
    return replay(spark, path, tumbling, "complete")
