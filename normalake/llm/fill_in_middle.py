"""Fill-in-middle transformation of whole texts, cut at token borders.

Method: tokens are ``[A-Za-z]+|[^A-Za-z]`` over code points, an automaton of
two states (in a run of letters or not).  Texts are cut into chunks of bytes;
each chunk gives its state-transition function and how many tokens begin in it
for each state it may be entered in.  These pairs compose associatively, so a
parallel prefix scan resolves every chunk's entry state and the tokens before
it; a cut is then found in the one chunk that holds it.

Texts up to ``giant`` bytes are done where they are read.  A larger one is cut
into rows, one a chunk, that Spark spreads over all tasks; only the summaries
of a document's chunks (2 GB / CHUNK at most) meet, and the cuts' places go
back to the text.

Defined cases: a null text counts as empty; a null doc_id hashes as ``seed:``;
an empty table gives no rows; rows that repeat give equal results.  Columns of
docs with the names of the result's are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from normalake.llm._skew import unclashed
from normalake.llm._text import Memo, joined, small_batches
from normalake.sources.tables import stored

CHUNK, GIANT = 1 << 16, 1 << 22
#: Of 100 documents so many are transformed at most, and of 100 of these so many as suffix, prefix, middle.
TRANSFORMED, SPM = 90, 20
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"


@Memo
def _letters() -> np.ndarray:
    t = np.zeros(256, bool)
    t[65:91] = t[97:123] = True
    return t


def starts(part: np.ndarray, state: int) -> np.ndarray:
    """Where tokens begin in a chunk entered in the state (1: after a letter)."""
    letter = _letters()[part]
    before = np.concatenate(([bool(state)], letter[:-1]))[: len(part)]
    return np.flatnonzero(np.where(letter, ~before, (part & 0xC0) != 0x80))


def summaries(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each chunk (begin, end) and state it may be entered in: the state
    at its end and how many tokens begin in it, as (chunks, 2, 2)."""
    letter = _letters()[data]
    after = np.concatenate(([False], letter[:-1]))[: len(data)]
    total = np.concatenate(([0], np.cumsum(np.where(letter, ~after, (data & 0xC0) != 0x80))))
    lo, hi = bounds[:, 0], bounds[:, 1]
    some = hi > lo
    first, last, prev = (np.zeros(len(bounds), bool) for _ in range(3))
    first[some], last[some], prev[some] = letter[lo[some]], letter[hi[some] - 1], after[lo[some]]
    count = total[hi] - total[lo]
    out = np.empty((len(bounds), 2, 2), np.int64)
    for state in (0, 1):
        out[:, state, 0] = np.where(some, last, state)
        out[:, state, 1] = count + (first & prev & (state == 0)) - (first & ~prev & (state == 1))
    return out


def composed(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The summaries of chunks that stand one before the other, as one."""
    then = np.take_along_axis(other, one[:, :, :1].repeat(2, 2), 1)
    return np.stack((then[:, :, 0], one[:, :, 1] + then[:, :, 1]), 2)


def resolved(found: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """summaries in order, first: each one's document's first chunk -> each
    chunk's entry state, the tokens before it, and those up to its end."""
    upto, step, at = found.copy(), 1, np.arange(len(found))
    while len(move := at[at - step >= first]):
        upto[move] = composed(upto[move - step], upto[move])
        step *= 2
    state, before = np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
    later = at[at > first]
    state[later], before[later] = upto[later - 1, 0].T
    return state, before, upto[:, 0, 1]


def plan(doc_id: int | None, n: int, seed: int) -> tuple[int, int, int, int]:
    """Tokens before the middle and up to its end, and the two rolls."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    return a, b, h[2] % 100, h[3] % 100


def arranged(text: bytes, lo: int, hi: int, rolls: tuple[int, int]) -> tuple[str, int | None, int | None, bytes]:
    """form, code points of prefix and of middle, output."""
    if not text or rolls[0] >= TRANSFORMED or any(x in text for x in (PREFIX, SUFFIX, MIDDLE)):
        return "plain", None, None, text
    prefix, middle, suffix = text[:lo], text[lo:hi], text[hi:]
    chars = [len(x.decode("utf-8", "replace")) for x in (prefix, middle)]
    if rolls[1] < SPM:
        return "spm", *chars, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return "psm", *chars, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


def chunk_bounds(at: np.ndarray, chunk: int) -> tuple[np.ndarray, np.ndarray]:
    """at: where each text begins (a byte after its predecessor's line feed) ->
    (begin, end) of the chunks of all, one at least, and each text's first."""
    sizes = np.diff(at) - 1
    many = np.maximum(1, -(-sizes // chunk))
    first = np.concatenate(([0], np.cumsum(many)))
    nth = np.arange(first[-1]) - np.repeat(first[:-1], many)
    lo = np.repeat(at[:-1], many) + nth * chunk
    return np.stack((lo, np.minimum(lo + chunk, np.repeat(at[:-1] + sizes, many))), 1), first


def cuts(texts: pa.Array, ids: list, seed: int, chunk: int) -> Iterator[tuple[int, int, int, tuple[int, int]]]:
    """For each text its tokens, the bytes before the middle and up to its
    end, and the rolls."""
    data, at = joined(texts)
    bounds, first = chunk_bounds(at, chunk)
    state, before, upto = resolved(summaries(data, bounds), np.repeat(first[:-1], np.diff(first)))
    for i, doc_id in enumerate(ids):
        lo, hi = first[i], first[i + 1]
        n = int(upto[hi - 1])
        a, b, *rolls = plan(doc_id, n, seed)
        found = []
        for t in (a, b):
            if t == n:
                found.append(int(at[i + 1] - 1 - at[i]))
            else:
                k = lo + int(np.searchsorted(before[lo:hi], t, side="right")) - 1
                part = data[bounds[k, 0] : bounds[k, 1]]
                found.append(int(bounds[k, 0] - at[i] + starts(part, state[k])[t - before[k]]))
        yield n, *found, tuple(rolls)


COLUMNS = "n long, form string, prefix_chars long, middle_chars long, output string"
_KINDS = {"n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64(), "output": pa.large_binary()}


def _out(batch: pa.RecordBatch, keep: list[str], found: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array([x[k] for x in found], kind) for k, kind in enumerate(_KINDS.values())]
    columns[-1] = columns[-1].cast(pa.large_string())
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *columns], names=[*keep, *_KINDS])


def _bytes(texts: pa.Array) -> list[bytes]:
    return [x or b"" for x in texts.cast(pa.large_binary()).to_pylist()]


def fill_in_middle(docs: DataFrame, seed: int = 1, chunk: int = CHUNK, giant: int = GIANT) -> DataFrame:
    """All columns of docs (doc_id, text, ...), then those of COLUMNS."""
    docs = docs.drop(*[c for c in docs.columns if c in _KINDS])
    own, of = unclashed(docs)
    keep, text = list(of.values()), of["text"]
    schema = StructType([*own.schema.fields, *StructType.fromDDL(COLUMNS).fields])
    length = F.coalesce(F.octet_length(text), F.lit(0))

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text):
            texts, ids = batch.column(text), batch.column("_id").to_pylist()
            yield _out(batch, keep, [(n, *arranged(t, lo, hi, rolls)) for t, (n, lo, hi, rolls) in zip(_bytes(texts), cuts(texts, ids, seed, chunk))])

    own = own.withColumn("_id", F.col(of["doc_id"]).cast("long"))
    some = own.where(length <= giant).mapInArrow(small, schema)
    return some.union(_giants(own.where(length > giant), keep, text, schema, seed, chunk)).toDF(*docs.columns, *_KINDS)


def _giants(docs: DataFrame, keep: list[str], text: str, schema: StructType, seed: int, chunk: int) -> DataFrame:
    """The same of documents whose chunks are spread over all tasks. Texts and
    ids that repeat have their chunks once."""
    docs = docs.withColumn("_sha", F.sha2(text, 256))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "_text"):
            for doc_id, sha, value in zip(batch.column("_id"), batch.column("_sha"), batch.column("_text")):
                whole = value.cast(pa.large_binary()).as_buffer()
                for c, lo in enumerate(range(0, len(whole), chunk)):
                    yield pa.RecordBatch.from_pylist([{"_id": doc_id.as_py(), "_sha": sha.as_py(), "c": c, "part": whole[lo : lo + chunk].to_pybytes()}], schema=pa.schema([("_id", pa.int64()), ("_sha", pa.string()), ("c", pa.int64()), ("part", pa.binary())]))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.frombuffer(x, np.uint8) for x in batch.column("part").to_pylist()]
            found = [summaries(x, np.array([[0, len(x)]]))[0].ravel().tolist() for x in parts]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("_id", "_sha", "c")), pa.array(found, pa.list_(pa.int64())), pa.array([len(x) for x in parts], pa.int64())], names=["_id", "_sha", "c", "summary", "size"])

    def chosen(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("c").drop_duplicates("c")
        state, before, upto = resolved(np.stack(rows["summary"].to_list()).reshape(-1, 2, 2), np.zeros(len(rows), np.int64))
        n = int(upto[-1])
        doc_id = None if pd.isna(key[0]) else int(key[0])
        a, b, *rolls = plan(doc_id, n, seed)
        out = []
        for which, t in enumerate((a, b)):
            k = int(np.searchsorted(before, t, side="right")) - 1 if t < n else len(rows) - 1
            out.append((doc_id, key[1], int(rows["c"].iloc[k]), which, int(state[k]), int(t - before[k]) if t < n else -1, n, *rolls))
        names = ["_id", "_sha", "c", "which", "state", "nth", "n", "roll", "order"]
        return pd.DataFrame(out, columns=names).astype({"_id": "Int64"})

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = []
            for c, part, state, nth in zip(*(batch.column(x).to_pylist() for x in ("c", "part", "state", "nth"))):
                own = np.frombuffer(part, np.uint8)
                at.append(c * chunk + (len(own) if nth < 0 else int(starts(own, state)[nth])))
            keys = ["_id", "_sha", "which", "n", "roll", "order"]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in keys), pa.array(at, pa.int64())], names=[*keys, "at"])

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text):
            more = zip(*(batch.column(x).to_pylist() for x in ("n", "lo", "hi", "roll", "order")))
            yield _out(batch, keep, [(n, *arranged(t, lo, hi, (roll, order))) for t, (n, lo, hi, roll, order) in zip(_bytes(batch.column(text)), more)])

    key = "_id long, _sha string"
    parts = docs.select("_id", "_sha", F.col(text).alias("_text")).mapInArrow(split, f"{key}, c long, part binary")
    parts = stored(parts.repartition("_id", "_sha", "c"))
    found = parts.mapInArrow(summed, f"{key}, c long, summary array<long>, size long")
    picked = found.groupBy("_id", "_sha").applyInPandas(chosen, f"{key}, c long, which int, state int, nth long, n long, roll int, order int")
    same = F.col("p._id").eqNullSafe(F.col("q._id")) & (F.col("p._sha") == F.col("q._sha"))
    met = parts.dropDuplicates(["_id", "_sha", "c"]).alias("p").join(picked.alias("q"), same & (F.col("p.c") == F.col("q.c")))
    at = met.select("p._id", "p._sha", "p.c", "part", "which", "state", "nth", "n", "roll", "order").mapInArrow(placed, f"{key}, which int, n long, roll int, order int, at long")
    at = at.groupBy("_id", "_sha", "n", "roll", "order").agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
    own = docs.alias("p").join(at.alias("q"), same).select(*(f"p.{c}" for c in keep), "n", "lo", "hi", "roll", "order")
    return own.mapInArrow(put, schema)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output of a form was made of."""
    parts = F.split(output, "<[PSM]>", -1)
    piece = lambda k: F.try_element_at(parts, F.lit(k))
    return F.when(F.col(form) == "plain", F.col(output)).when(F.col(form) == "psm", F.concat(piece(2), piece(4), piece(3))).otherwise(F.concat(piece(3), piece(4), piece(2)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    digest = lambda x: F.sha2(x.cast("binary"), 256)
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(restored()).alias("restored_sha256"))


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '(?s)[A-Za-z]+|[^A-Za-z]') AS tokens,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
h AS (
  SELECT *, len(tokens) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(tokens) + 1) AS c1, ('0x' || substr(h, 9, 8))::BIGINT % (len(tokens) + 1) AS c2,
         ('0x' || substr(h, 17, 8))::BIGINT % 100 AS r1, ('0x' || substr(h, 25, 8))::BIGINT % 100 AS r2 FROM d),
parts AS (
  SELECT doc_id, t, n,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r1 >= 90 THEN 'plain' WHEN r2 < 20 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(tokens[1 : least(c1, c2)], '') AS p, array_to_string(tokens[least(c1, c2) + 1 : greatest(c1, c2)], '') AS m,
         array_to_string(tokens[greatest(c1, c2) + 1 : n], '') AS s FROM h)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN len(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN len(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(p || m || s) AS restored_sha256
FROM parts
"""
