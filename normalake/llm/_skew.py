"""Joining rows with a value of their own group, however large the group and
whatever columns they have."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 64


def salt(*columns: str) -> Column:
    """A number from 0 to 63 that rows of one group differ in."""
    return F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int")


def salts_seen(column: str) -> Column:
    """An aggregate: which salts the rows of a group have, as bits."""
    return F.bit_or(F.expr(f"shiftleft(1L, {column})"))


def per_salt(groups: DataFrame, seen: str, column: str) -> DataFrame:
    """One row for each group and salt that its rows have: never more rows
    than the groups' members, and 64 a group at most."""
    bits = F.expr(f"filter(sequence(0, {SALTS - 1}), i -> (shiftright({seen}, i) & 1L) = 1L)")
    return groups.withColumn(column, F.explode(bits)).drop(seen)


def attached(rows: DataFrame, key: str, by: str, table: DataFrame, how: str = "inner") -> DataFrame:
    """rows joined with table on key, where many rows may have the same key:
    they are dealt by a salt of column ``by``, and the table's row goes to each
    salt seen."""
    salted = rows.withColumn("_s", salt(by))
    keys = per_salt(salted.groupBy(key).agg(salts_seen("_s").alias("_seen")), "_seen", "_s")
    return salted.join(keys.join(table, key, how), [key, "_s"]).drop("_s")


def unclashed(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs under names that clash with none, and these by the old ones."""
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names
