"""From raw documents to packed training sequences, in five stages.

Each stage works on all rows its predecessor kept and, but for the last,
returns the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from normalake.llm import decontaminate, exact_dedup, langid, near_dedup, packing
from normalake.llm._skew import unclashed
from normalake.sources.tables import dropped, stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or of no language with enough confidence, go."""
    found = langid.language_id(docs, langid.fit(docs))
    return found.where(~F.col("rejected")).select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts only the document that op4 keeps stays, as one row."""
    found = stored(exact_dedup.repeats(docs).where("NOT best OR copies > 1").selectExpr("doc_id AS _id", "n_cp AS _n", "text_sha256 AS _sha", "best AS _best"))
    own, of = unclashed(docs)
    text = F.coalesce(F.col(of["text"]), F.lit(""))
    body = F.sha2(F.translate(text, exact_dedup.WHITE, ""), 256)
    same = F.col(of["doc_id"]).cast("long").eqNullSafe(F.col("_id")) & (F.char_length(text) == F.col("_n")) & (body == F.col("_sha"))
    alone = own.join(found.hint("shuffle_hash"), same, "left_anti")
    # of rows that repeat both doc_id and text, the least by all columns stays (as JSON, as maps have no order)
    row = F.struct(*of.values())
    many = own.join(found.where("_best").hint("shuffle_hash"), same).groupBy("_id", "_n", "_sha").agg(F.min_by(row, F.to_json(row)).alias("r")).select("r.*")
    return alone.union(many).toDF(*docs.columns) if found.where("_best").take(1) else alone.toDF(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies only its smallest doc_id stays."""
    own, of = unclashed(docs)
    gone = near_dedup.near_dedup(docs).where(~F.col("kept")).select(F.col("doc_id").alias("_id")).distinct()
    return own.join(gone.hint("shuffle_hash"), F.col(of["doc_id"]).cast("long") == F.col("_id"), "left_anti").toDF(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    return packing.best_fit(docs)


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact),
    ("MinHash near-dedup", near),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packed),
]

#: A trained classifier and best-fit packing are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, sf_dir))
        dropped(before)
    return STAGES[-1][1](spark, docs, sf_dir)
