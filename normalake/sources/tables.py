"""Tables kept for later steps in the folder that all executors share."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Lets Spark delete the shuffle files of a query when it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local: dict[str, str] = {}
_views: dict[tuple, DataFrame] = {}
_scopes: list[list[DataFrame]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` of the session names. Only a
    local master, as in tests, may leave it unset: all its tasks are on this
    machine, and a temporary folder serves."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if where:
        return where.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = "file://" + tempfile.mkdtemp(prefix="normalake-")
    return _local[app]


def unique_folder(spark: SparkSession, name: str) -> str:
    """A new folder there, gone when the application ends."""
    where = f"{shared_folder(spark)}/normalake-{name}-{uuid.uuid4().hex}"
    path, fs = _path(spark, where)
    fs.deleteOnExit(path)
    return where


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def stored(df: DataFrame) -> DataFrame:
    """The same rows, written as Parquet to the shared folder and read from
    there: a step that is run again starts at the files. The files go when the
    application ends, or before by dropped(); the shuffle files of the step go
    as soon as the table is written."""
    spark = df.sparkSession
    where = f"{shared_folder(spark)}/normalake-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(where)
    finally:
        spark.conf.set(_CLEANUP, before)
    path, fs = _path(spark, where)
    fs.deleteOnExit(path)
    out = spark.read.schema(df.schema).parquet(where)
    out._stored_at = where
    if _scopes:
        _scopes[-1].append(out)
    return out


@contextmanager
def released() -> Iterator[None]:
    """Tables that are stored within go at its end: for a caller who has
    written a result, which reads them, elsewhere by then."""
    _scopes.append([])
    try:
        yield
    finally:
        dropped(*_scopes.pop())


def swept(spark: SparkSession, hours: float = 48) -> list[str]:
    """Deletes this library's folders in the shared folder that are older than
    so many hours, as applications leave them that were killed."""
    at, fs = _path(spark, f"{shared_folder(spark)}/normalake-*")
    before = (time.time() - hours * 3600) * 1000
    old = [f.getPath() for f in fs.globStatus(at) or [] if f.getModificationTime() < before]
    for path in old:
        fs.delete(path, True)
    return sorted(path.getName() for path in old)


def dropped(*frames: DataFrame) -> None:
    """Delete the files of stored frames that no later step reads. Python's
    garbage goes as well, as plans that it still refers to stay on the driver."""
    for frame in frames:
        if where := frame.__dict__.pop("_stored_at", None):
            path, fs = _path(frame.sparkSession, where)
            fs.delete(path, True)
    gc.collect()


def renamed(frame: DataFrame, *names: str) -> DataFrame:
    """A stored frame under other column names, still to be dropped."""
    out = frame.toDF(*names)
    out._stored_at = frame.__dict__.pop("_stored_at")
    return out


def stored_once(spark: SparkSession, name: str, inputs: list[str], make) -> DataFrame:
    """A view that many queries read, made and stored at its first use in the
    application, and again if an input's files have changed since."""
    seen = []
    for name_of in inputs:
        path, fs = _path(spark, name_of)
        seen += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(path)]
    key = (spark.sparkContext.applicationId, name, tuple(seen))
    if key not in _views:
        _views[key] = stored(make())
        for scope in _scopes:  # later queries read it
            scope[:] = [x for x in scope if x is not _views[key]]
    return _views[key]


def numbered(df: DataFrame, by: str, name: str) -> DataFrame:
    """df with each row's place, from 1, in the order of ``by``: ranges of it
    are counted, then each numbers its own rows."""
    ranged = stored(df.repartitionByRange(by).withColumn("_part", F.spark_partition_id()))
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    # one row a partition
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(by))
    return ranged.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + inside).drop("_part", "_before")
