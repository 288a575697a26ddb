"""Language ID: averaged hashed subword embeddings with a linear softmax.

Method: a text's letter runs (letters and marks by Unicode; all else parts
words) give hashed byte 3- and 4-grams (with word edges); the mean of their embeddings feeds a linear softmax.  Embeddings and
weights are trained by stochastic gradient descent in numpy on a bounded
sample, on slices of random length so that short texts do as well as long
ones.  A temperature and a rejection threshold are calibrated on held-back
sample rows.  As the model is linear after averaging, scoring adds one
precomputed logit row for each gram.

Learns from text and lang only, of rows with a lang and crc32(doc_id as text)
mod 4 other than 2: of each lang up to EACH rows of smallest hash, together up
to MOST_CHARS characters (or one text of each lang, if these are more), so that
a rare language is learned as well.  Texts
over LONGEST characters are left out of training (never of prediction).
Prediction reads the whole text and nothing else.

Defined cases: null text, or no letter (Unicode category L): ``und`` with score
0, rejected.  No rows to learn from: ``und`` with score 0 everywhere, and only
texts without letters are rejected.  A null doc_id is not held out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from normalake.llm._sample import id_crc, labelled_sample
from normalake.llm._text import joined, small_batches

EACH, LONGEST, MOST_CHARS = 900, 20_000, 6_000_000
BUCKETS, DIM, EPOCHS, RATE = 1 << 16, 16, 6, 0.4
#: A text is rejected if its score is under the score that this share of the
#: calibration rows stays under, but never above REJECT_MOST.
REJECT_SHARE, REJECT_MOST = 0.001, 0.5


def only_letters(texts: pa.Array) -> pa.Array:
    """The texts with a space for each run of characters above 0x7F that are
    neither letters nor marks."""
    return pc.replace_substring_regex(texts.cast(pa.large_string()), r"[^\x00-\x7F\p{L}\p{M}]+", " ")


def _letters() -> np.ndarray:
    """Letter bytes in lower case; all others become a space."""
    t = np.full(256, 32, np.uint32)
    for a in range(26):
        t[65 + a] = t[97 + a] = 97 + a
    t[128:] = np.arange(128, 256)
    return t


def grams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each byte: the bucket of the 3-gram and of the 4-gram around it, and
    whether they count (their inner bytes are letters)."""
    v = _letters()[np.concatenate((data, np.full(3, 32, np.uint8)))]
    n = len(data)
    letter = v != 32
    three = (v[:n] << np.uint32(16)) | (v[1 : n + 1] << np.uint32(8)) | v[2 : n + 2]
    b3 = (three * np.uint32(2654435761)) >> np.uint32(16)
    b4 = ((three * np.uint32(2246822519) + v[3 : n + 3]) * np.uint32(3266489917)) >> np.uint32(16)
    in3 = letter[1 : n + 1]
    return b3, in3, b4, in3 & letter[2 : n + 2]


def listed(text: str) -> np.ndarray:
    """The buckets of a text's grams, in text order, in two bytes each."""
    b3, in3, b4, in4 = grams(np.frombuffer(f" {text} ".encode(), np.uint8))
    return np.stack((b3, b4), 1).ravel()[np.stack((in3, in4), 1).ravel()].astype(np.uint16)


def _slice(g: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    n = min(len(g), int(np.exp(rng.uniform(np.log(8), np.log(600)))))
    lo = rng.integers(0, len(g) - n + 1)
    return g[lo : lo + n]


def train(texts: list[str], langs: list[str], seed: int = 7) -> dict:
    """The model: languages, a logit row for each bucket, bias, temperature,
    threshold. Every fifth row is kept for calibration."""
    names = sorted(set(langs))
    docs = [listed(t) for t in only_letters(pa.array(texts, pa.string())).to_pylist()]
    y = np.array([names.index(x) for x in langs])
    rng = np.random.default_rng(seed)
    usable = [i for i in range(len(docs)) if len(docs[i])]
    calib, fit = usable[::5], [i for k, i in enumerate(usable) if k % 5]
    fit = fit or usable
    emb = rng.normal(0, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    w, bias = np.zeros((DIM, len(names)), np.float32), np.zeros(len(names), np.float32)
    steps, done = EPOCHS * max(1, len(fit)), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(fit):
            at, count = np.unique(_slice(docs[i], rng), return_counts=True)
            share = (count / count.sum()).astype(np.float32)
            mean = share @ emb[at]
            z = mean @ w + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            rate = RATE * (1 - done / steps)
            back = w @ p
            w -= rate * np.outer(mean, p)
            bias -= rate * 0.1 * p
            emb[at] -= rate * 10 * share[:, None] * back
            done += 1
    table = emb @ w
    model = {"names": names, "table": table, "bias": bias, "temperature": 1.0, "threshold": 0.0}
    if calib:
        z = np.array([table[_slice(docs[i], rng)].mean(0) + bias for i in calib for _ in range(4)], np.float64)
        own = np.repeat(y[calib], 4)

        def loss(t: float) -> float:
            s = z / t
            return float(np.mean(np.log(np.exp(s - s.max(1, keepdims=True)).sum(1)) + s.max(1) - s[np.arange(len(s)), own]))

        model["temperature"] = min(np.geomspace(0.1, 4, 30).tolist(), key=loss)
        s = z / model["temperature"]
        p = np.exp(s - s.max(1, keepdims=True))
        best = (p / p.sum(1, keepdims=True)).max(1)
        model["threshold"] = float(min(REJECT_MOST, np.quantile(best, REJECT_SHARE)))
    return model


def fit(docs: DataFrame) -> dict | None:
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.coalesce(id_crc() % 4, F.lit(0)) != 2))
    got = labelled_sample(known, "lang", EACH, LONGEST, MOST_CHARS)
    return train([r.text for r in got], [r.label for r in got]) if got else None


def has_letters(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)


def score_texts(texts: pa.Array, model: dict | None) -> tuple[np.ndarray, np.ndarray]:
    """Index of the best language (-1: none) and its probability."""
    n = len(texts)
    if model is None:
        return np.full(n, -1), np.zeros(n)
    letters = has_letters(texts)
    data, at = joined(only_letters(texts))
    sums, counts = np.zeros((n, len(model["names"]))), np.zeros(n)
    tables = [np.append(np.ascontiguousarray(model["table"][:, k]), np.float32(0)) for k in range(sums.shape[1])]
    step = 1 << 18
    for lo in range(0, len(data), step):  # a gram starts before its block's first byte or in the block
        edge = data[lo - 1 : lo] if lo else data[-1:]
        b3, in3, b4, in4 = grams(np.concatenate((edge, data[lo : lo + step + 2])))
        size = min(step, len(data) - lo)
        b3, in3, b4, in4 = b3[:size], in3[:size], b4[:size], in4[:size]
        b3[~in3] = b4[~in4] = BUCKETS  # a row of zeros
        first = int(np.searchsorted(at, lo, side="right")) - 1
        cuts = at[first:n]
        cuts = np.maximum(cuts[cuts < lo + size] - lo, 0)
        rows = slice(first, first + len(cuts))
        counts[rows] += np.add.reduceat(in3.astype(np.int64) + in4, cuts)
        for k, table in enumerate(tables):
            sums[rows, k] += np.add.reduceat(table[b3] + table[b4], cuts, dtype=np.float64)
    z = (sums / np.maximum(counts, 1)[:, None] + model["bias"]) / model["temperature"]
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    return np.where(letters, p.argmax(1), -1), np.where(letters, p.max(1), 0.0)


def language_id(docs: DataFrame, model: dict | None) -> DataFrame:
    """All columns of docs, then lang_pred, score and rejected."""
    new = {"lang_pred": pa.string(), "score": pa.float64(), "rejected": pa.bool_()}
    kept = [c for c in docs.columns if c not in new]
    docs = docs.select(*kept)
    names = np.array([*(model["names"] if model else []), "und"], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            best, score = score_texts(batch.column("text"), model)
            rejected = (best < 0) | (score < model["threshold"]) if model else ~has_letters(batch.column("text"))
            more = [pa.array(names[best], pa.string()), pa.array(score), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *new])

    schema = StructType([*docs.schema.fields, *StructType.fromDDL("lang_pred string, score double, rejected boolean").fields])
    return docs.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = language_id(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", F.coalesce(id_crc() % 4 == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
