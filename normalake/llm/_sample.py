"""Bounded, repeatable training samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F


def id_crc(column: str = "doc_id") -> Column:
    """crc32 of the id as text; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def smallest_hashes(rows: DataFrame, n: int, *by: str) -> DataFrame:
    """The n rows whose hash of the given columns is smallest: a fixed
    pseudo-random sample. Rows must be narrow; each task sends n at most."""
    return rows.withColumn("_h", F.xxhash64(*by, F.lit(17))).orderBy("_h", *by).limit(n).drop("_h")


#: Labels of a sample, the most frequent first, and rows, one a label at least.
MOST_LABELS = MOST_ROWS = 50_000


def labelled_sample(rows: DataFrame, label: str, each: int, longest: int, most_chars: int) -> list[Row]:
    """rows (doc_id, text, label) -> a sample of (doc_id, text, label) for the
    driver: of each label the rows of smallest hash, up to ``each`` rows (fewer
    if MOST_ROWS are reached) and to its share of ``most_chars`` characters. A
    row that is too long for what is left of the share is passed over; if none
    fits, the label's shortest drawn row is taken, so a label that has a text
    always has a row. Texts over ``longest`` characters are left out, repeated
    rows count once. The hashes decide, so it is the same however the rows are
    dealt out.

    Labels are counted first, so that only rows with a small enough hash are
    ranked; texts come for the chosen rows only."""
    rows = rows.where(F.col("text").isNotNull() & F.col(label).isNotNull() & (F.char_length("text") <= longest))
    rows = rows.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("doc_id"), F.xxhash64("text").alias("c"), F.char_length("text").alias("n"), F.col(label).alias("label"), "text")
    counts = rows.groupBy("label").agg(F.count("*").alias("many")).orderBy(F.desc("many"), "label").limit(MOST_LABELS).collect()
    if not counts:
        return []
    each, share = max(1, min(each, MOST_ROWS // len(counts))), most_chars // len(counts)
    kind = rows.schema["label"].dataType.simpleString()
    # of hashes up to this one about four times as many rows as are wanted, or all
    limits = rows.sparkSession.createDataFrame([(r.label, min((1 << 63) - 1, int((4 * each + 64) / r.many * (1 << 63)))) for r in counts], f"label {kind}, _limit long")
    hashed = F.xxhash64("doc_id", "c", F.lit(17))
    narrow = rows.drop("text").withColumn("_h", hashed).join(F.broadcast(limits), "label").where("_h & 9223372036854775807 <= _limit").drop("_limit").distinct()
    order = [F.expr("_h & 9223372036854775807"), F.col("doc_id"), F.col("c")]
    ranked = narrow.withColumn("place", F.row_number().over(Window.partitionBy("label").orderBy(*order)))
    found, chosen = {}, []
    for r in sorted(ranked.where(f"place <= {each}").collect(), key=lambda r: r.place):  # MOST_ROWS, or one a label
        found.setdefault(r.label, []).append(r)
    for of in found.values():
        left, some = share, []
        for r in of:
            if r.n <= left:
                left -= r.n
                some.append(r)
        chosen += [(r.doc_id, r.c, r.label, r.place) for r in some or [min(of, key=lambda r: (r.n, r.place))]]
    ids = rows.sparkSession.createDataFrame(chosen, f"doc_id long, c long, label {kind}, place int")
    texts = rows.join(F.broadcast(ids), ["doc_id", "c", "label"]).groupBy("place", "doc_id", "c", "label").agg(F.min("text").alias("text"))
    return sorted(texts.select("doc_id", "text", "label", "place").collect(), key=lambda r: (r.place, r.label))
