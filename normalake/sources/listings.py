"""Archive listings as files, and the discovery strategies by name.

A listing file is a JSON array of arrays of strings whose first row names the
columns, which need not be the same or in the same order in all files.  Lines
are read by Spark, so a large file is split over tasks and any file system
serves; rows that are no such array are passed over.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from normalake.functions.identity import file_identity, without_scheme

#: The names that columns of a listing can have.
FIELDS = ("urlkey", "timestamp", "original", "mimetype", "statuscode", "digest", "length")
STRATEGIES: dict[str, Callable[[SparkSession, dict, str, str], DataFrame]] = {}
RESOURCE = "url string, ente string, fonte string, tipo_documento string, chave string, status string, wayback_snapshot string"


def strategy(name: str):
    """Registers a function (session, config, place, source) -> RESOURCE rows."""

    def deco(f):
        STRATEGIES[name] = f
        return f

    return deco


def archive_listing(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all listing files at path, in the columns of FIELDS; one
    that a file does not have is null. A file without a header row has no rows.
    Filters on the columns act where lines are read."""
    line = F.regexp_replace(F.trim("value"), r",\s*$", "")
    line = F.when(F.startswith(line, F.lit("[[")), F.substring(line, 2, 2**31 - 1)).otherwise(line)
    line = F.when(F.endswith(line, F.lit("]]")), F.regexp_replace(line, r"\]$", "")).otherwise(line)
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("_file"), F.explode(F.from_json(F.concat(F.lit("["), line, F.lit("]")), "array<array<string>>")).alias("_row"))
    known = F.array(*map(F.lit, FIELDS))
    heads = F.size("_row") > 0
    heads = heads & F.forall("_row", lambda x: F.array_contains(known, x)) & F.array_contains("_row", F.lit("original"))
    # a row for each file
    header = rows.where(heads).groupBy("_file").agg(F.min("_row").alias("_head"))
    met = rows.where(~F.coalesce(heads, F.lit(False))).join(header, "_file")
    return met.select(*[F.try_element_at("_row", F.nullif(F.array_position("_head", F.lit(f)), F.lit(0)).cast("int")).alias(f) for f in FIELDS])


@strategy("wayback-cdx")
def archived(spark: SparkSession, config: dict, ente: str, fonte: str) -> DataFrame:
    """Files that a listing (config ``path``) shows were there, under the scheme
    of ``prefix``. A name without an identity keeps its stem as a key that
    identifies nothing. The snapshot keeps the address as it was archived."""
    scheme = "https://" if config["prefix"].startswith("https") else "http://"
    name = F.element_at(F.split("original", "/"), -1)
    found = archive_listing(spark, config["path"]).where("statuscode = '200' AND lower(original) LIKE '%.pdf'").withColumn("_i", file_identity(name))
    key = F.coalesce("_i.chave", F.concat(F.lit("documento-"), F.regexp_replace(name, r"\.[^.]*$", "")))
    url = F.when(F.col("original").rlike("^https?://"), F.concat(F.lit(scheme), without_scheme(F.col("original")))).otherwise(F.col("original"))
    snapshot = F.concat(F.lit("https://web.archive.org/web/"), "timestamp", F.lit("/"), "original")
    return found.select(url.alias("url"), F.lit(ente).alias("ente"), F.lit(fonte).alias("fonte"), F.coalesce("_i.tipo", F.lit("")).alias("tipo_documento"), key.alias("chave"), F.lit("pending").alias("status"), snapshot.alias("wayback_snapshot"))


@strategy("sequential")
def sequential(spark: SparkSession, config: dict, ente: str, fonte: str) -> DataFrame:
    """Addresses by number from a ``template`` with {num}, ``start`` to ``end``."""
    kind, n = config.get("tipo", "lei"), F.col("id")
    head, tail = config["template"].split("{num}", 1)
    rows = spark.range(config["start"], config["end"] + 1)
    return rows.select(F.concat(F.lit(head), n, F.lit(tail)).alias("url"), F.lit(ente).alias("ente"), F.lit(fonte).alias("fonte"), F.lit(kind).alias("tipo_documento"), F.format_string("%s-%05d", F.lit(kind), n).alias("chave"), F.lit("pending").alias("status"), F.lit(None).cast("string").alias("wayback_snapshot"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """ente, fonte, tipo_ingestion, probe, place (of a strategy in its source),
    strategy, config (its options, as JSON) from a nested sources manifest."""
    kind = "ente STRING, fontes MAP<STRING, STRUCT<tipo_ingestion: STRING, probe: STRING, discovery: ARRAY<STRING>>>"
    m = spark.read.text(path, wholetext=True).select(F.from_json("value", kind).alias("m")).select("m.ente", F.explode("m.fontes").alias("fonte", "f"))
    return m.select("ente", "fonte", "f.tipo_ingestion", "f.probe", F.posexplode("f.discovery").alias("place", "config")).withColumn("strategy", F.get_json_object("config", "$.strategy"))


def discover(spark: SparkSession, entries: list[dict], ente: str, fonte: str) -> tuple[DataFrame, dict[str, str]]:
    """The rows of all of a source's strategies, and why others failed, by
    name. A strategy that is not known is an error; one that fails, whenever
    its rows are read, is left out."""
    from normalake.sources.tables import stored

    unknown = [e["strategy"] for e in entries if e["strategy"] not in STRATEGIES]
    if unknown:
        raise ValueError(f"unknown strategies: {unknown}")
    out, failed = spark.createDataFrame([], RESOURCE), {}
    for e in entries:
        try:
            out = out.unionByName(stored(STRATEGIES[e["strategy"]](spark, e, ente, fonte)))
        except Exception as error:  # noqa: BLE001
            failed[e["strategy"]] = str(error)
    return out, failed
