"""The append-only capture index: newest wins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from normalake.functions.identity import BUCKET, ENDINGS, bucket_item, bucket_start, content_name, flip_scheme, key_identity, raw_id_parts

#: Ways in which rows that share a norm are dealt.
SALTS = 16
KEY = ["tipo", "numero", "rendicao", "formato", "sha256"]


def append(index: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows not there yet by KEY, unidentified rows also by source; of rows
    equal in these within the batch, one."""
    source = F.when(F.coalesce("numero", F.lit("")) == "", F.col("source"))
    rows = rows.groupBy(*KEY, source.alias("_of")).agg(F.min(F.struct(*rows.columns)).alias("_r")).select("_r.*")
    i, r = index.alias("i"), rows.alias("r")
    same = F.lit(True)
    for c in KEY:
        same = same & F.col(f"i.{c}").eqNullSafe(F.col(f"r.{c}"))
    unidentified = F.coalesce("r.numero", F.lit("")) == ""
    same = same & (~unidentified | F.col("i.source").eqNullSafe(F.col("r.source")))
    return index.unionByName(rows.alias("r").join(i, same, "left_anti").select(*index.columns))


def remove(index: DataFrame, promoted: DataFrame) -> DataFrame:
    return index.join(promoted.select("uuid5", "source").distinct(), ["uuid5", "source"], "left_anti")


def newest(index: DataFrame, seq: str, *key: str) -> DataFrame:
    """The last appended row of each key, as one aggregation."""
    return index.groupBy(*key).agg(F.max_by(F.struct(*index.columns), seq).alias("r")).select("r.*")


def first_hit(wanted: DataFrame, snapshots: DataFrame, value: str) -> DataFrame:
    """wanted (url, ...) with the value that snapshots (url, value) have for the
    address, else for it under the other scheme, else null."""
    other = flip_scheme(F.col("url"))
    own = wanted.join(snapshots.withColumnRenamed(value, "_own"), "url", "left").withColumn("_other_url", other)
    met = own.join(snapshots.select(F.col("url").alias("_other_url"), F.col(value).alias("_other")), "_other_url", "left")
    return met.withColumn(value, F.coalesce("_own", "_other")).drop("_own", "_other", "_other_url")


def collisions(index: DataFrame) -> DataFrame:
    """Short names of more than one content."""
    return index.groupBy("uuid5").agg(F.countDistinct("sha256").alias("conteudos")).where("conteudos > 1")


def identities(index: DataFrame) -> DataFrame:
    """The distinct keys of numbered captures; no number beyond a long is one."""
    number = F.when(F.col("numero").rlike(r"^\d+$"), F.col("numero").try_cast("bigint"))
    return index.select("tipo", number.alias("n")).where("n IS NOT NULL").select(F.format_string("%s-%05d", "tipo", "n").alias("chave")).distinct()


def reconcile(holding: DataFrame, known: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """holding rows whose source has a known (source, tipo, numero) move to the
    index: (index, holding) afterwards."""
    found = holding.drop("tipo", "numero").join(known.select("source", "tipo", "numero"), "source").select(*index.columns)
    return append(index, found), remove(holding, found)


def lineage(raw: DataFrame, index: DataFrame, seq: str, slugs: list[str], suffix: str = ".pdf", rendicao: str | None = None, base: str = "https://archive.org/download/", prefix: str = "norma", raw_prefix: str = "raw") -> DataFrame:
    """raw (raw_id, ...) followed hop by hop: the longest place slug, the key's
    identity, the bucket's item, its newest capture, the file and what it was
    captured from. Adds ente, fonte, tipo, numero, item, uuid5, source, url and
    hop, where the way ended: ``external`` (no raw id: the url is that of a file
    named like the item), ``unidentified`` (no number in its key),
    ``uncaptured`` (nothing in the index, whose format is that of the suffix),
    ``found``. Only found and external ids have a url; every raw row stays. The
    index (tipo, numero, rendicao, formato, uuid5, source, seq) is reduced to a
    row for each norm before norms with many raw ids are dealt by salt."""
    parts, suffixes = raw_id_parts(F.col("raw_id"), slugs, raw_prefix), F.lit(suffix)
    rows = raw.withColumn("_p", parts).withColumn("_k", key_identity(F.col("_p.chave")))
    rows = rows.select(*raw.columns, "_p.ente", "_p.fonte", "_k.tipo", "_k.numero", (F.col("_p").isNull()).alias("_external"))
    if rendicao is not None:
        index = index.where(F.col("rendicao") == rendicao)
    if suffix in ENDINGS:
        index = index.where(F.col("formato") == ENDINGS[suffix])
    whole = index.withColumn("_n", F.when(F.col("numero").rlike(r"^\d+$"), F.col("numero").try_cast("bigint"))).where("_n IS NOT NULL")
    last = whole.groupBy("tipo", F.col("_n").alias("numero")).agg(F.max_by(F.struct("uuid5", "source"), seq).alias("_c"))
    rows = rows.withColumn("_s", F.pmod(F.xxhash64("raw_id"), F.lit(SALTS)).cast("int"))
    keys = rows.where("numero IS NOT NULL").select("tipo", "numero", "_s").distinct()
    met = rows.join(keys.join(last, ["tipo", "numero"]), ["tipo", "numero", "_s"], "left")
    item = bucket_item(F.col("ente"), F.col("fonte"), F.col("tipo"), F.col("numero"), prefix)
    name = F.format_string("%s-%05d_%s", "tipo", "numero", "_c.uuid5")
    hop = F.when(F.col("_external"), "external").when(F.col("numero").isNull(), "unidentified").when(F.col("_c").isNull(), "uncaptured").otherwise("found")
    url = F.when(F.col("_external"), F.concat(F.lit(base), "raw_id", F.lit("/"), "raw_id", suffixes)).when(F.col("_c").isNotNull(), F.concat(F.lit(base), item, F.lit("/"), name, suffixes))
    return met.select(*raw.columns, "ente", "fonte", "tipo", "numero", F.when(F.col("numero").isNotNull(), item).alias("item"), "_c.uuid5", "_c.source", url.alias("url"), hop.alias("hop"))


def resolve(raw: DataFrame, index: DataFrame, seq: str, base: str = "https://archive.org/download/", prefix: str = "norma", rendicao: str | None = None, suffix: str | None = None) -> DataFrame:
    """raw (ente, fonte, tipo, numero) with the URL of the newest capture's
    bytes, null if there is none; rendicao and suffix choose among the captures
    (a suffix by the format it is made of: recognised text comes from a pdf)."""
    if rendicao is not None:
        index = index.where(F.col("rendicao") == rendicao)
    if suffix is not None:
        index = index.where(F.col("formato") == ENDINGS.get(suffix, suffix.lstrip(".")))
    last = newest(index, seq, "tipo", "numero").select("tipo", F.col("numero").try_cast("bigint").alias("numero"), "formato", content_name(F.col("sha256")).alias("name"))
    met = raw.join(last, ["tipo", "numero"], "left")
    item = F.format_string("%s_%s_%s_%s_%04d-%04d", F.lit(prefix), "ente", "fonte", "tipo", bucket_start(F.col("numero")), bucket_start(F.col("numero")) + BUCKET - 1)
    return met.withColumn("url", F.when(F.col("name").isNotNull(), F.concat(F.lit(base), item, F.lit("/"), "name", F.lit(suffix) if suffix is not None else F.concat(F.lit("."), "formato")))).drop("formato", "name")
