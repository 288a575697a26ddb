"""Writes by key as joins: ledger and staging tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from normalake.sources.tables import numbered


def insert_or_ignore(table: DataFrame, rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of a key stays: what is there, then the first that comes."""
    first = rows.groupBy(key).agg(F.min_by(F.struct(*rows.columns), order).alias("r")).select("r.*")
    return table.unionByName(first.join(table.select(key), key, "left_anti").select(*table.columns))


def insert_or_replace(table: DataFrame, rows: DataFrame, key: str, given: list[str]) -> DataFrame:
    """The last row of a key wins in the given columns, null included; the
    others keep their value."""
    old, new = table.alias("o"), rows.alias("n")
    here = F.col(f"n.{key}").isNotNull()
    out = [F.coalesce(f"o.{key}", f"n.{key}").alias(key)]
    for c in table.columns:
        if c != key:
            out.append((F.when(here, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")) if c in given else F.col(f"o.{c}")).alias(c))
    return old.join(new, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer").select(*out)


def update_status(table: DataFrame, changes: DataFrame, now: Column) -> DataFrame:
    """changes (url, status, snapshot): a snapshot replaces only if there is one."""
    t, c = table.alias("t"), changes.alias("c")
    hit = F.col("c.url").isNotNull()
    snapshot = F.when(hit & (F.coalesce("c.snapshot", F.lit("")) != ""), F.col("c.snapshot")).otherwise(F.col("t.wayback_snapshot"))
    new = {"status": F.when(hit, F.col("c.status")).otherwise(F.col("t.status")), "ultima_tentativa": F.when(hit, now).otherwise(F.col("t.ultima_tentativa")), "wayback_snapshot": snapshot}
    return t.join(c, F.col("t.url") == F.col("c.url"), "left").select(*[new.get(x, F.col(f"t.{x}")).alias(x) for x in table.columns])


def pending(table: DataFrame, ente: str | None = None, kind: str | None = None, limit: int | None = None) -> DataFrame:
    found = table.where(F.col("status") == "pending")
    if ente:
        found = found.where(F.col("ente") == ente)
    if kind:
        found = found.where(F.col("tipo_documento") == kind)
    return found.orderBy("url").limit(limit) if limit else found


def skip_existing(wanted: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    return wanted.join(existing.select(key).distinct(), key, "left_anti")


def without_sidecar(ids: DataFrame, sidecars: DataFrame, prefix: str) -> DataFrame:
    """ids (raw_id) with the prefix that sidecars (raw_id) lack."""
    return skip_existing(ids.where(F.startswith("raw_id", F.lit(prefix))), sidecars, "raw_id")


def paced(rows: DataFrame, host: str, order: str, seconds: float) -> DataFrame:
    """rows with wait, the seconds after the start at which each may be asked
    for, so that no host is asked more often than once in so many; of a host in
    the order of a column. Places come from one range sort of all rows, so a
    host with most of them loads no single task."""
    placed = numbered(rows.withColumn("_k", F.struct(host, order)), "_k", "_place")
    first = placed.groupBy(F.col(host).alias("_h")).agg(F.min("_place").alias("_first"))
    met = placed.join(first, F.col(host).eqNullSafe(F.col("_h")))
    return met.withColumn("wait", (F.col("_place") - F.col("_first")) * F.lit(seconds)).drop("_k", "_place", "_h", "_first")
