"""Toxicity: multiple-instance learning with noisy-or over sentences.

Method: a sentence (text up to ``.``, ``!``, ``?`` or a line end) has the
probability sigmoid(bias + sum of its distinct hashed words' weights), or 0 if
none of its words has a weight, so that clean text may have any length; a
document is toxic unless all its sentences are clean: 1 - prod(1 - p).  Weights are
trained from document labels alone, by Adagrad on the noisy-or likelihood;
rows held back from that calibrate the document score where it is not 0.
Sentences with p >= 0.5 are then the located ones.

Learns labels only of rows with crc32(doc_id as text) mod 5 other than 0: of
each class up to EACH ids of smallest hash, and of their texts up to half of
MOST_CHARS characters, with texts over LONGEST characters left out of training
(never of scoring).  Only words in at least MIN_DF sample texts get a weight;
weights under LEAST become 0.

Defined cases: null and empty texts, or no word at all: score 0, predicted 0.
No labels to learn from: score 0 everywhere.  A null doc_id is not held out.
Rows of labels without doc_id or toxic are ignored; an id with labels of both
kinds is learned as both, equal rows count once, and of an id's several texts
the smallest is learned.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from normalake.llm._sample import id_crc, smallest_hashes
from normalake.llm._text import hashed_words, joined, small_batches

EACH, LONGEST, MOST_CHARS = 3000, 20_000, 20_000_000
BITS, MIN_DF, MIN_Z, ROUNDS, RATE, DECAY = 18, 5, 4.0, 500, 1.0, 2e-3
FIRST_BIAS, LEAST = -8.0, 0.05


def sentences(texts: pa.Array) -> dict:
    """The bytes, the words, each sentence's first word and text, and each
    word's bucket and sentence."""
    data, at = joined(texts)
    starts, ends, h = hashed_words(data, "word")
    stop = np.zeros(256, bool)
    stop[[10, 13, 33, 46, 63]] = True
    number = np.cumsum(stop[data], dtype=np.int64)[starts]
    new = np.diff(number, prepend=-1) != 0
    first = np.flatnonzero(new)
    return {"data": data, "at": at, "starts": starts, "ends": ends, "first": first, "doc": np.searchsorted(at, starts[first], side="right") - 1, "bucket": (h >> np.uint64(64 - BITS)).astype(np.int64), "sentence": np.cumsum(new) - 1}


def _distinct(sentence: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.unique((sentence << BITS) + bucket)
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


def _probabilities(weights: np.ndarray, bias: float, sentence: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
    p = 1 / (1 + np.exp(-np.clip(bias + np.bincount(sentence, weights[bucket], minlength=n), -30, 30)))
    return np.where(np.bincount(sentence, minlength=n) > 0, p, 0.0)


def calibrated(score: np.ndarray, scale: tuple[float, float]) -> np.ndarray:
    """The score with its logit scaled and shifted; 0 stays 0."""
    p = np.clip(score, 1e-9, 1 - 1e-9)
    z = np.clip(scale[0] * np.log(p / (1 - p)) + scale[1], -50, 50)
    return np.where(score > 0, 1 / (1 + np.exp(-z)), 0.0)


def train(texts: list[str], toxic: list[int], weight_clean: float = 1.0) -> dict:
    """Weights from four fifths of the rows; the rest, with clean texts counted
    weight_clean times (the sample has relatively few), calibrates scores."""
    held = np.arange(len(texts)) % 5 == 4
    if len(texts) < 100:
        return _train(texts, toxic) | {"scale": (1.0, 0.0)}
    model = _train([t for t, h in zip(texts, held) if not h], [t for t, h in zip(toxic, held) if not h]) | {"scale": (1.0, 0.0)}
    rest = [t for t, h in zip(texts, held) if h]
    score, y = score_texts(pa.array(rest, pa.string()), model)[0], np.array(toxic, float)[held]
    score, y = score[score > 0], y[score > 0]
    p = np.clip(score, 1e-9, 1 - 1e-9)
    x = np.stack((np.log(p / (1 - p)), np.ones(len(p))), 1)
    each = np.where(y > 0, 1.0, weight_clean)
    beta = np.array([1.0, 0.0])
    loss = lambda b: each @ np.logaddexp(0, np.where(y > 0, -1, 1) * (x @ b)) + ((b - [1.0, 0.0]) ** 2).sum() / 2
    for _ in range(30):  # Newton's method for two numbers, with a weak prior at no change
        q = 1 / (1 + np.exp(-np.clip(x @ beta, -50, 50)))
        grad = x.T @ (each * (y - q)) - (beta - [1.0, 0.0])
        step = np.linalg.solve((x.T * (each * q * (1 - q))) @ x + np.eye(2), grad)
        while loss(beta + step) > loss(beta) and np.abs(step).max() > 1e-9:
            step = step / 2
        beta = beta + step
    return model | {"scale": (float(max(beta[0], 0.1)), float(beta[1]))}


def _train(texts: list[str], toxic: list[int]) -> dict:
    s = sentences(pa.array(texts, pa.string()))
    sentence, bucket = _distinct(s["sentence"], s["bucket"])
    doc, n, m = s["doc"], len(texts), len(s["first"])
    y = np.array(toxic, bool)
    pairs = np.unique((doc[sentence] << BITS) + bucket)
    in_doc, toxic_doc = pairs & ((1 << BITS) - 1), y[pairs >> BITS]
    df = np.bincount(in_doc, minlength=1 << BITS)
    share = y.mean() if n else 0.0
    z = (np.bincount(in_doc, toxic_doc, minlength=1 << BITS) - share * df) / np.sqrt(np.maximum(df * share * (1 - share), 1e-9))
    live = ((df >= MIN_DF) & (np.abs(z) >= MIN_Z))[bucket]
    sentence, bucket = sentence[live], bucket[live]
    used, slot = np.unique(bucket, return_inverse=True)
    w, bias, square, square_b = np.zeros(len(used)), FIRST_BIAS, np.full(len(used), 1e-6), 1e-6
    for _ in range(ROUNDS if m else 0):
        p = _probabilities(w, bias, sentence, slot, m)
        clean = np.exp(np.bincount(doc, np.log1p(-p), minlength=n))
        whole = np.clip(1 - clean, 1e-9, 1)
        up = np.where(y[doc], p * (clean / whole)[doc], -p)  # of the log likelihood, by a sentence's logit
        g = np.bincount(slot, up[sentence], minlength=len(used)) - DECAY * w
        square += g * g
        w += RATE * g / np.sqrt(square)
        gb = up.sum()
        square_b += gb * gb
        bias += 0.2 * RATE * gb / np.sqrt(square_b)
    weights = np.zeros(1 << BITS, np.float32)
    weights[used] = np.where(np.abs(w) < LEAST, 0, w)
    return {"weights": weights, "bias": float(bias)}


def fit(docs: DataFrame, labels: DataFrame) -> dict | None:
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (id_crc() % 5 != 0)).select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") != 0).cast("int").alias("toxic"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = known.distinct()
    ids = smallest_hashes(known.where("toxic = 0"), EACH, "doc_id").union(smallest_hashes(known.where("toxic = 1"), EACH, "doc_id"))
    # 2 * EACH ids at most are broadcast; what comes back is cut to MOST_CHARS before it is collected
    found = texts.where(F.char_length("text") <= LONGEST).join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    upto = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id")
    got = found.withColumn("used", F.sum(F.char_length("text").cast("long")).over(upto)).where(f"used <= {MOST_CHARS // 2}").collect()
    got.sort(key=lambda r: (zlib.crc32(str(r.doc_id).encode()), r.doc_id, r.toxic))
    if not got:
        return None
    counts = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    ratio = {k: counts.get(k, 0) / max(1, sum(r.toxic == k for r in got)) for k in (0, 1)}
    return train([r.text for r in got], [r.toxic for r in got], ratio[0] / ratio[1] if ratio[1] else 1.0)


def score_texts(texts: pa.Array, model: dict | None) -> tuple[np.ndarray, list[list[dict]]]:
    """Each text's score and its sentences with p >= 0.5 by code points."""
    n = len(texts)
    if model is None:
        return np.zeros(n), [[] for _ in range(n)]
    s = sentences(texts)
    heavy = model["weights"][s["bucket"]] != 0
    p = _probabilities(model["weights"], model["bias"], *_distinct(s["sentence"][heavy], s["bucket"][heavy]), len(s["first"]))
    score = 1 - np.exp(np.bincount(s["doc"], np.log1p(-p), minlength=n)) if len(p) else np.zeros(n)
    found: list[list[dict]] = [[] for _ in range(n)]
    last = np.append(s["first"][1:], len(s["starts"])) - 1
    points: dict[int, np.ndarray] = {}
    for k in np.flatnonzero(p >= 0.5):
        d = int(s["doc"][k])
        base = int(s["at"][d])
        if d not in points:
            points = {d: np.cumsum((s["data"][base : s["at"][d + 1]] & 0xC0) != 0x80)}
        lo, hi = int(s["starts"][s["first"][k]]) - base, int(s["ends"][last[k]]) - base
        found[d].append({"start": int(points[d][lo]) - 1, "end": int(points[d][hi - 1]), "score": float(p[k])})
    return calibrated(np.clip(score, 0, 1), model["scale"]), found


def toxicity(docs: DataFrame, model: dict | None) -> DataFrame:
    """All columns of docs, then score and sentences (start, end, score)."""
    new = {"score": pa.float64(), "sentences": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))}
    docs = docs.select(*[c for c in docs.columns if c not in new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            score, found = score_texts(batch.column("text"), model)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score), pa.array(found, new["sentences"])], names=[*batch.schema.names, *new])

    schema = StructType([*docs.schema.fields, *StructType.fromDDL("score double, sentences array<struct<start:bigint,end:bigint,score:double>>").fields])
    return docs.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    found = toxicity(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(id_crc() % 5 == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("sentences").alias("n_sentences"), F.expr("sentences.start").cast("string").alias("sentence_starts"))
