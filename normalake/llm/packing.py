"""Best-fit packing of documents into training sequences under conflicts.

Method: documents fall into blocks of about BLOCK rows by a hash; a block packs
its pieces by decreasing length.  Open bins are ordered by residual and carry a
bitmap of sources and one of duplicate clusters; the search goes from the
tightest bin that has room to its successors until one has neither the piece's
source nor its cluster, else a bin opens.  Length is counted in words (runs
other than white space); a document longer than CAPACITY is cut into full
pieces, each a bin of its own, and a rest that is packed.

Only ids, lengths, sources and content hashes move, never texts.  A block is
bounded, so is its memory, and a lost block is packed again by itself.

Defined cases: null or empty texts have length 0 and one empty piece that takes
no room (but respects conflicts).  A null source conflicts with nothing.
Duplicate clusters are equal texts apart from white space; empty texts are
none.  Rows that repeat are packed each.  A null doc_id is packed like any
other.  A table without a source column has no source conflicts.  Blocks depend
on the rows alone, not on how they are dealt out: rows equal in all that counts
are numbered.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CAPACITY, BLOCK = 2048, 2048


def pack(lengths: list[int], sources: list, clusters: list, capacity: int = CAPACITY) -> list[int]:
    """The bin of each piece; pieces have at most capacity words. Bins are
    numbered as they open. None conflicts with nothing."""
    bits: dict = {}
    bit = lambda kind, x: 0 if x is None else 1 << bits.setdefault((kind, x), len(bits))
    out = [0] * len(lengths)
    open_: list[list[int]] = []  # [residual, bin], in order
    marks: list[int] = []  # source and cluster bitmap of each bin
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        need, mask = lengths[i], bit("s", sources[i]) | bit("c", clusters[i])
        lo, hi = 0, len(open_)
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (mid + 1, hi) if open_[mid][0] < need else (lo, mid)
        while lo < len(open_) and marks[open_[lo][1]] & mask:
            lo += 1
        if lo < len(open_):
            residual, b = open_.pop(lo)
        else:
            residual, b = capacity, len(marks)
            marks.append(0)
        marks[b] |= mask
        out[i] = b
        insort(open_, [residual - need, b])
    return out


def _pack_block(frame: pd.DataFrame, capacity: int) -> pd.DataFrame:
    frame = frame.sort_values(["doc_id", "n_words", "source", "cluster", "copy"], na_position="last", kind="stable").reset_index(drop=True)
    n = frame["n_words"].to_numpy()
    full = np.maximum(0, (n - 1) // capacity)  # full pieces before the last
    piece = pd.DataFrame({"at": np.repeat(np.arange(len(n)), full + 1)})
    piece["piece"] = piece.groupby("at").cumcount()
    piece["start"] = piece["piece"] * capacity
    piece["length"] = np.minimum(capacity, n[piece["at"]] - piece["start"])
    none = lambda s: [None if pd.isna(x) else x for x in s]
    sources, clusters = none(frame["source"]), none(frame["cluster"])
    piece["bin"] = pack(piece["length"].tolist(), [sources[a] for a in piece["at"]], [clusters[a] for a in piece["at"]], capacity)
    piece["bin_start"] = piece.groupby("bin")["length"].cumsum() - piece["length"]
    own = frame.iloc[piece["at"]].reset_index(drop=True)
    return pd.DataFrame({"doc_id": own["doc_id"], "piece": piece["piece"].astype("int32"), "start_word": piece["start"], "n_words": piece["length"], "block": own["block"], "bin": piece["bin"].astype("int32"), "bin_start": piece["bin_start"]})


def best_fit(docs: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """docs (doc_id, text, source) -> doc_id, piece, start_word, n_words,
    block, bin, bin_start: where each piece of each document goes."""
    if capacity < 1 or block < 1:
        raise ValueError("capacity and block must be at least 1")
    text = F.coalesce(F.col("text"), F.lit(""))
    body = F.translate(text, " \t\n\x0b\x0c\r", "")
    source = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_words"), source.alias("source"), F.when(F.length(body) > 0, F.xxhash64(body)).alias("cluster"))
    blocks = max(1, -(-docs.count() // block))
    # a task that runs again gives the same rows: copies differ by their number alone
    key = ["doc_id", "n_words", "source", "cluster"]
    slim = slim.groupBy(*key).agg(F.count("*").alias("copies")).withColumn("copy", F.explode(F.expr("sequence(1L, copies)"))).drop("copies")
    slim = slim.withColumn("block", F.pmod(F.xxhash64(*key, "copy"), F.lit(blocks)))
    schema = "doc_id long, piece int, start_word long, n_words long, block long, bin int, bin_start long"
    return slim.groupBy("block").applyInPandas(lambda frame: _pack_block(frame, capacity), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))
