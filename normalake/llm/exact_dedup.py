"""Exact dedup: group by a 128-bit content hash, compare bytes in groups.

Method: texts without white space are grouped by their MD5 (128 bits) together
with the bytes themselves, so equal hashes of unequal bytes stay apart.  The
grouping combines on the map side: a group of any size leaves each task as one
row, and no task gathers a group.  Each row then meets its group's result under
a salted key; rows that repeat doc_id, length and normalised text are one row
with their number until then, so that exactly one of them stays.

Defined cases: a null text counts as empty, and all empty texts are one group.
A null doc_id comes after every other in ties.  Of rows that repeat doc_id,
length and normalised text one stays, whichever, as they give the same result.
Other columns are
neither read nor needed; columns of the result's names in the input are
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from normalake.llm._skew import per_salt, salt, salts_seen

#: Space and 0x09-0x0D.
WHITE = " \t\n\x0b\x0c\r"
_SHIFT = "100000000000000000000"  # 10^20, above every shifted 64-bit id
_LONGEST = "4294967295"


def _rank() -> Column:
    """Longer texts first, then smaller ids, as one decimal number: hash
    aggregation can keep its minimum in place, unlike that of a struct."""
    number = "decimal(38,0)"
    above = F.lit(_LONGEST).cast("decimal(10,0)") - F.col("n_cp").cast("decimal(10,0)")
    ident = F.coalesce(F.col("doc_id").cast("decimal(20,0)") + F.lit("9223372036854775808").cast("decimal(19,0)"), F.lit("18446744073709551616").cast("decimal(20,0)"))
    return ((above * F.lit(_SHIFT).cast("decimal(21,0)")).cast(number) + ident.cast(number)).cast(number)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, keep_id, group_size, kept, text_sha256,
    one row for each row of docs."""
    found = repeats(docs).withColumn("i", F.explode(F.expr("sequence(1L, copies)")))
    return found.select("doc_id", "keep_id", "group_size", (F.col("best") & (F.col("i") == 1)).alias("kept"), "text_sha256")


def repeats(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_cp (the text's code points), text_sha256,
    copies (the number of rows equal in these), keep_id, group_size, and best:
    of these copies one stays."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.char_length(text).alias("n_cp"), F.translate(text, WHITE, "").alias("body"))
    rows = rows.withColumn("h", F.md5("body")).withColumn("s", salt("doc_id", "n_cp"))
    same = rows.groupBy("h", "body").agg(F.min(_rank()).alias("best"), F.count("*").alias("n"), salts_seen("s").alias("seen"))
    same = same.select("h", F.sha2("body", 256).alias("sha"), "best", "n", "seen")
    # one row for each text by now; more than one for a hash and digest would be a collision of both
    groups = same.groupBy("h", "sha").agg(F.min("best").alias("best"), F.sum("n").alias("group_size"), F.bit_or("seen").alias("seen"), F.count("*").alias("texts"))
    groups = groups.where(F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts share MD5 and SHA-256"))).otherwise(F.lit(True)))
    left = F.col("best") - F.floor(F.col("best") / F.lit(_SHIFT).cast("decimal(21,0)")).cast("decimal(18,0)") * F.lit(_SHIFT).cast("decimal(21,0)")
    ident = left.cast("decimal(38,0)") - F.lit("9223372036854775808").cast("decimal(19,0)")
    groups = groups.select("h", "sha", "best", F.when(ident < F.lit("9223372036854775808").cast("decimal(19,0)"), ident.cast("long")).alias("keep_id"), "group_size", "seen")
    narrow = rows.select("doc_id", "n_cp", "h", F.sha2("body", 256).alias("sha"), "s").groupBy("doc_id", "n_cp", "h", "sha", "s").agg(F.count("*").alias("copies"))
    out = narrow.join(per_salt(groups, "seen", "s"), ["h", "sha", "s"])
    return out.select("doc_id", "n_cp", F.col("sha").alias("text_sha256"), "copies", "keep_id", "group_size", (_rank() == F.col("best")).alias("best"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_cp,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
w AS (
  SELECT doc_id, text_sha256,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_cp DESC, doc_id) AS keep_id,
         row_number() OVER (PARTITION BY text_sha256 ORDER BY n_cp DESC, doc_id) AS place,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM w
"""
