"""Annotation records: offsets from quoted text, and pools to annotate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from normalake.operators import sampling
from normalake.sources.tables import stored

SPAN = "struct<category: string, start: bigint, end: bigint>"


def nth_position(text: str, needle: str, nth: str) -> Column:
    """Where (from 0) the n-th occurrence of a needle stands, columns by name;
    occurrences may overlap. Null if there is none, also for an empty needle or
    n under 1. It goes from one occurrence to the next."""
    step = f"(p, i) -> if(p < 0, p, if(locate({needle}, {text}, p + 1) = 0, -1, locate({needle}, {text}, p + 1)))"
    some = f"{nth} >= 1 AND {nth} <= char_length({text}) AND {needle} <> ''"
    return F.expr(f"CASE WHEN {some} THEN nullif(aggregate(sequence(1, CAST({nth} AS INT)), 0, {step}), -1) - 1 END")


def from_spans(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """records (doc, text, spans: array of category, start, end, finds: array of
    category, match, nth) -> (doc, text, label), with the offsets of finds after
    the spans given, and the finds that are not in the text (doc, category,
    match, nth). nth counts from 1 and is 1 if null. A record without text is
    in neither."""
    whole = records.where("text IS NOT NULL")
    each = whole.select("doc", "text", F.posexplode("finds").alias("at", "f")).select("doc", "text", "at", "f.category", "f.match", F.coalesce("f.nth", F.lit(1)).cast("bigint").alias("nth"))
    each = each.withColumn("start", nth_position("text", "match", "nth").cast("bigint")).drop("text")
    each = stored(each)
    span = F.struct("category", "start", (F.col("start") + F.char_length("match")).alias("end")).cast(SPAN)
    found = each.where("start IS NOT NULL").groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("at", span.alias("s")))).alias("_found"))
    given = F.coalesce(F.col("spans").cast(f"array<{SPAN}>"), F.array().cast(f"array<{SPAN}>"))
    label = F.concat(given, F.coalesce(F.transform("_found", lambda x: x["s"]), F.array().cast(f"array<{SPAN}>")))
    return whole.join(found, "doc", "left").select("doc", "text", label.alias("label")), each.where("start IS NULL").select("doc", "category", "match", "nth")


def annotation_pool(rows: DataFrame, n: int, floor: int = 0, cap: int | None = None, least: int = 200, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """rows (raw_id, ente, fonte, text) -> records (text, label, info) to
    annotate, and the manifest (ente, fonte, available, picked, kept, skipped).
    Equally many are drawn of each source; a drawn row without text, or with
    fewer than ``least`` characters, is skipped and not replaced."""
    named = rows.select("raw_id", "ente", "fonte", "text", F.concat_ws("/", "ente", "fonte").alias("_of"))
    picked = stored(sampling.per_source(named, "_of", "raw_id", n, floor, cap, seed))
    long = F.coalesce(F.char_length("text") >= least, F.lit(False))
    info = F.struct("raw_id", "ente", "fonte").alias("info")
    records = picked.where(long).select("text", F.array().cast(f"array<{SPAN}>").alias("label"), info)
    zero, one = F.lit(0).alias, F.lit(1).alias
    all_ = named.select("ente", "fonte", one("available"), zero("picked"), zero("kept"), zero("skipped"))
    drawn = picked.select("ente", "fonte", zero("available"), one("picked"), long.cast("int").alias("kept"), (~long).cast("int").alias("skipped"))
    counts = [F.sum(k).alias(k) for k in ("available", "picked", "kept", "skipped")]
    return records, all_.union(drawn).groupBy("ente", "fonte").agg(*counts)
