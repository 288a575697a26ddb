"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from normalake.llm._skew import per_salt, salt, salts_seen
from normalake.sources.tables import dropped, renamed, stored


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """pairs (u, v): every u's neighbours v are linked to the smallest node
    among u and these. A node's least neighbour is found by map-side
    combination and joined back under salted keys, so a hub with any number of
    neighbours loads no single task."""
    if large:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    both = both.withColumn("s", salt("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m"), salts_seen("s").alias("seen")).withColumn("m", F.least("u", "m"))
    joined = both.join(per_salt(least, "seen", "s").hint("shuffle_hash"), ["u", "s"])
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def _unfinished(pairs: DataFrame) -> bool:
    """Whether a node has two targets, or is a target and has one."""
    ends = pairs.select("u", F.lit(1).alias("as_u"), F.lit(0).alias("as_v")).union(pairs.select(F.col("v").alias("u"), F.lit(0), F.lit(1)))
    seen = ends.groupBy("u").agg(F.sum("as_u").alias("as_u"), F.max("as_v").alias("as_v"))
    return bool(seen.agg(F.max(F.when((F.col("as_u") > 1) | ((F.col("as_u") > 0) & (F.col("as_v") > 0)), 1).otherwise(0))).collect()[0][0])


def components(edges: DataFrame) -> DataFrame:
    """edges (u, v) of long ids -> (node, root): each linked node other than
    its component's smallest, with that smallest node."""
    pairs = stored(_star(edges.select("u", "v").where(F.col("u") != F.col("v")), False))
    while _unfinished(pairs):
        last, pairs = pairs, stored(_star(_star(pairs, True), False))
        dropped(last)
    return renamed(pairs, "node", "root")
