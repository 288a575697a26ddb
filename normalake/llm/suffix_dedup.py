"""Removal of passages that repeat, by suffix sorting.

A byte goes if a string of WINDOW bytes covers it that also starts earlier: in
a document of smaller doc_id, or earlier in the same one.  Bytes are those of
the text in UTF-8; strings never cross documents.

Method: suffix arrays by linear grouping construction (``_suffixes``).  For
this, equal strings must meet in one task.  Each string of WINDOW bytes belongs
to its anchor, the GRAM bytes in it of least hash, so equal strings have equal
anchors.  The strings of one anchor's place make a context (up to 160 bytes).
Contexts meet by anchor; equal ones count once, as their earliest, and the
others' bytes go.  An anchor with several contexts is a bucket: these are
fetched from the texts, and the suffix array of a bucket puts equal strings of
WINDOW bytes side by side, of which all but the earliest go.

Buckets of more than MOST contexts are split by cells: strings whose anchor
begins a like number of bytes after them (16, then 4, then 1) have more bytes in
common, by which they meet anew.  Anchors that a sample of at most SAMPLED texts
shows to be very common are split before they are shuffled at all; the sample
decides how the work is dealt, never a result.  So a line that a third of all
documents have loads no single task, whatever stands around it.

Defined cases: a null text counts as empty; texts of fewer than WINDOW bytes
keep all.  Rows that share a doc_id count as one document, in which an earlier
start in either text is earlier; repeated rows give equal results.  Rows
without a doc_id count as one document after all others.  An empty table gives
no rows.  What is left of a text is binary, as a cut may part a character.
Columns of docs with the names of the result's are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from normalake.llm._skew import unclashed
from normalake.llm._suffixes import suffix_arrays
from normalake.llm._text import Memo, hash_tables, joined, mix, small_batches
from normalake.sources.tables import stored

WINDOW, GRAM = 100, 40
SPAN = WINDOW - GRAM + 1
#: Offsets of an anchor in its strings that go together, by level.
CELLS = (SPAN, 16, 4, 1)
#: Contexts of a bucket that are sorted together.
MOST = 32
#: Texts, and characters of each, that show very common anchors; contexts of one anchor among them that make it so.
SAMPLED, SAMPLED_CHARS, COMMON = 1024, 20_000, 8
BLOCK, AT_ONCE = 1 << 18, 16
#: Contexts whose suffixes are sorted at a time.
SORTED = 2048
_U = np.uint64
_LOW = _U((1 << 20) - 1)


@Memo
def _values() -> np.ndarray:
    return np.random.Generator(np.random.PCG64(977)).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)


class Hashed:
    """The hash of any range of some bytes (at most 1 << 19)."""

    def __init__(self, data: np.ndarray):
        _, power, self.back = hash_tables()
        self.sums = np.zeros(len(data) + 1, _U)
        np.cumsum(_values()[data] * power[: len(data)], out=self.sums[1:])

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return mix((self.sums[hi] - self.sums[lo]) * self.back[lo])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """The least of each w consecutive values."""
    n = len(x)
    rows = np.full(-(-n // w) * w, np.iinfo(x.dtype).max, x.dtype)
    rows[:n] = x
    rows = rows.reshape(-1, w)
    upto = np.minimum.accumulate(rows, 1).ravel()
    on = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(on[: n - w + 1], upto[w - 1 : n])


def anchors(data: np.ndarray, ends: np.ndarray, lo: int, hashed: Hashed) -> tuple[np.ndarray, ...]:
    """The contexts of data, which begins at lo of a batch whose documents end
    at ends: document, anchor's place, first and last string's start, key."""
    g = hashed(np.arange(len(data) - GRAM + 1), np.arange(GRAM, len(data) + 1))
    least = sliding_min((g & ~_LOW) | np.arange(len(g), dtype=_U), SPAN)
    s = np.arange(len(least))
    doc = np.searchsorted(ends, s + lo)
    s = s[s + lo + WINDOW <= ends[doc]]
    p = (least[s] & _LOW).astype(np.int64)
    new = np.flatnonzero(np.diff(p, prepend=-1))
    p = p[new]
    return doc[s[new]], p, s[new], s[np.append(new[1:], len(s)) - 1], g[p]


def in_cells(p: np.ndarray, first: np.ndarray, last: np.ndarray, level: int, hashed: Hashed) -> tuple[np.ndarray, ...]:
    """Contexts split into the cells of a level: which context, first and last
    string's start, key. The key is of the bytes that all strings of a cell
    have in common."""
    size = CELLS[level]
    low, high = (p - last) // size, (p - first) // size
    many = high - low + 1
    of = np.repeat(np.arange(len(p)), many)
    cell = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many) + low[of]
    least, most = cell * size, np.minimum(cell * size + size, SPAN) - 1
    a, b = np.maximum(first[of], p[of] - most), np.minimum(last[of], p[of] - least)
    return of, a, b, mix(hashed(p[of] - least, p[of] - most + WINDOW) + (cell * 4 + level).astype(_U) * _U(0x9E3779B97F4A7C15))


def keyed(p: np.ndarray, first: np.ndarray, last: np.ndarray, key: np.ndarray, hashed: Hashed, common: np.ndarray) -> tuple[np.ndarray, ...]:
    """Contexts, those with a common key split until it is none: which
    context, anchor's place, first and last string's start, level, key."""
    of, level, out = np.arange(len(p)), 0, []
    while len(of):
        often = np.zeros(len(of), bool)
        if len(common) and level + 1 < len(CELLS):
            often = common[np.minimum(np.searchsorted(common, key), len(common) - 1)] == key
        out.append((of[~often], p[~often], first[~often], last[~often], np.full((~often).sum(), level), key[~often]))
        level += 1
        if not often.any():
            break
        of, p, first, last = of[often], p[often], first[often], last[often]
        part, first, last, key = in_cells(p, first, last, level, hashed)
        of, p = of[part], p[part]
    return tuple(np.concatenate(x) for x in zip(*out))


def contexts(texts: pa.Array, common: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Of some texts at a time: document, first string's start in it, anchor's
    offset from that, strings less one, level, key, and a hash of the context."""
    data, at = joined(texts)
    ends = at[1:] - 1
    step = BLOCK * AT_ONCE
    for begin in range(0, len(data), step):
        found = []
        for lo in range(begin, min(begin + step, len(data) - WINDOW + 1), BLOCK):
            part = data[lo : lo + BLOCK + WINDOW - 1]
            hashed = Hashed(part)
            doc, *rest = anchors(part, ends, lo, hashed)
            of, p, first, last, level, key = keyed(*rest, hashed, common)
            size = (p - first) * 64 + last - first
            whole = mix(hashed(first, last + WINDOW) + size.astype(_U) * _U(0xC2B2AE3D27D4EB4F))
            found.append((doc[of], first + lo - at[doc[of]], p - first, last - first, level, key, whole))
        if found:
            yield tuple(np.concatenate(x) for x in zip(*found))


def merged(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of documents, those that touch as one."""
    order = np.lexsort((lo, doc))
    doc, lo, hi = doc[order], lo[order], hi[order]
    if not len(doc):
        return doc, lo, hi
    wide = int(hi.max()) + 1
    reach = np.maximum.accumulate(doc * wide + hi)
    new = np.flatnonzero(np.concatenate(([True], doc[1:] * wide + lo[1:] > reach[:-1])))
    return doc[new], lo[new], reach[np.append(new[1:], len(doc)) - 1] - doc[new] * wide


def _meta(start: np.ndarray, level: np.ndarray, offset: np.ndarray, more: np.ndarray) -> np.ndarray:
    return start << 16 | level << 12 | offset << 6 | more


#: A context's parts out of meta; a range that goes has its end as ctx.
_START, _LEVEL, _OFFSET, _MORE = "shiftright(meta, 16)", "(shiftright(meta, 12) & 3L)", "(shiftright(meta, 6) & 63L)", "(meta & 63L)"


def _listed(common: np.ndarray):
    """Batches (o, t, text) -> their contexts, of equal ones in a batch the
    earliest, and the ranges of the others (goes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            ids, marks = (batch.column(c).to_numpy() for c in ("o", "t"))
            for doc, start, offset, more, level, key, ctx in contexts(batch.column("text"), common):
                order = np.lexsort((start, ids[doc], ctx, key))
                k, c = key[order], ctx[order]
                first = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]) | (c[1:] != c[:-1]))))
                least = order[np.repeat(first, np.diff(first, append=len(order)))]
                later = (ids[doc[order]] != ids[doc[least]]) | (start[order] != start[least])
                gone, keep = order[later], order[~later]
                d, lo, hi = merged(doc[gone], start[gone], start[gone] + more[gone] + WINDOW)
                rows = {
                    "goes": np.repeat([False, True], [len(keep), len(d)]),
                    "key": np.concatenate((key[keep], mix(marks[d].view(_U) + lo.astype(_U)))).view(np.int64),
                    "ctx": np.concatenate((ctx[keep].view(np.int64), hi)),
                    "o": ids[np.concatenate((doc[keep], d))],
                    "t": marks[np.concatenate((doc[keep], d))],
                    "meta": np.concatenate((_meta(start[keep], level[keep], offset[keep], more[keep]), lo << 16)),
                }
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows.values()], names=list(rows))

    return run


def _meta(start: np.ndarray, level: np.ndarray, offset: np.ndarray, more: np.ndarray) -> np.ndarray:
    return start << 16 | level << 12 | offset << 6 | more


def _met(rows: DataFrame, *same: str) -> DataFrame:
    """rows (goes, key, o, meta, ...), contexts equal if they are in the
    columns: with how many different ones their key has (many), whether a row
    stands for its context (best), and whether it goes."""
    rows = rows.repartition("goes", "key")  # serves both windows
    key = Window.partitionBy("goes", "key")
    each = Window.partitionBy("goes", "key", *same).orderBy("o", F.expr(_START))
    rows = rows.withColumn("best", F.row_number().over(each) == 1)
    later = (F.col("o") != F.first("o").over(each)) | (F.expr(_START) != F.first(F.expr(_START)).over(each))
    return rows.withColumn("later", later).withColumn("many", F.sum(F.col("best").cast("int")).over(key))


_GOES = ["o", "t", f"{_START} AS lo", f"{_START} + {_MORE} + {WINDOW} AS hi"]


def _common(docs: DataFrame) -> np.ndarray:
    """The keys that COMMON contexts or more of a bounded sample have."""
    some = docs.where(F.char_length("text") <= SAMPLED_CHARS).orderBy(F.xxhash64("t", "o"), "t", "o").limit(SAMPLED).select("text").toArrow()
    common = np.zeros(0, _U)
    for _ in CELLS[1:]:
        found = [(key, ctx) for batch in some.to_batches() for *_, key, ctx in contexts(batch.column("text"), common)]
        if not found:
            break
        key, ctx = (np.concatenate(x) for x in zip(*found))
        each = np.unique(np.stack((key, ctx), 1), axis=0)[:, 0]
        often, many = np.unique(each, return_counts=True)
        new = np.setdiff1d(often[many >= COMMON], common)
        if not len(new):
            break
        common = np.union1d(common, new)
    return common


_CONTEXT = "goes boolean, key long, many long, o long, t long, meta long, bytes binary"


def _fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (o, t, text, wanted) -> the bytes of the wanted contexts."""
    for batch in small_batches(batches, "text"):
        wanted = batch.column("wanted")
        of, inner = np.repeat(np.arange(batch.num_rows), np.diff(wanted.offsets.to_numpy())), wanted.flatten()
        key, many, meta = (inner.field(k).to_numpy() for k in range(3))
        raw = batch.column("text").cast(pa.large_binary()).to_pylist()
        lo, hi = meta >> 16, (meta >> 16) + (meta & 63) + WINDOW
        for k in range(0, len(of), 1 << 16):
            part = slice(k, k + (1 << 16))
            found = [raw[d][a:b] for d, a, b in zip(of[part].tolist(), lo[part].tolist(), hi[part].tolist())]
            own = [np.zeros(len(found), bool), key[part], many[part], batch.column("o").to_numpy()[of[part]], batch.column("t").to_numpy()[of[part]], meta[part], found]
            yield pa.RecordBatch.from_arrays([*map(pa.array, own[:-1]), pa.array(found, pa.binary())], names=["goes", "key", "many", "o", "t", "meta", "bytes"])


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts with their bytes, split into the cells of the next level."""
    for whole in batches:
        for k in range(0, whole.num_rows, 2048):
            batch = whole.slice(k, 2048)
            raw = batch.column("bytes").to_pylist()
            at = np.cumsum([0] + [len(x) for x in raw])
            data, meta = np.frombuffer(b"".join(raw), np.uint8), batch.column("meta").to_numpy()
            hashed, first = Hashed(data), at[:-1]
            start, level, p, last = meta >> 16, (meta >> 12 & 3) + 1, first + (meta >> 6 & 63), first + (meta & 63)
            for own in np.unique(level):
                rows = np.flatnonzero(level == own)
                part, a, b, key = in_cells(p[rows], first[rows], last[rows], int(own), hashed)
                row = rows[part]
                meta_of = _meta(start[row] + a - first[row], np.full(len(row), own), p[row] - a, b - a)
                found = [raw[r][x:y] for r, x, y in zip(row.tolist(), (a - first[row]).tolist(), (b - first[row] + WINDOW).tolist())]
                arrays = [np.zeros(len(row), bool), key.view(np.int64), np.zeros(len(row), np.int64), *(batch.column(c).to_numpy()[row] for c in ("o", "t")), meta_of]
                yield pa.RecordBatch.from_arrays([*map(pa.array, arrays), pa.array(found, pa.binary())], names=["goes", "key", "many", "o", "t", "meta", "bytes"])


def repeats(key: np.ndarray, o: np.ndarray, meta: np.ndarray, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts sorted by key -> the ranges that go, as (context, begin, end)
    in their documents: the suffixes of each key's contexts are sorted, and of
    equal strings of WINDOW bytes the earliest stays."""
    size = np.array([len(x) for x in raw], np.int64)
    new = np.flatnonzero(np.diff(key, prepend=key[:1] - 1))
    of_key = np.repeat(np.arange(len(new)), np.diff(new, append=len(key)))
    # each context and a 1; after the last of a key a 0; bytes from 2 on
    at = np.cumsum(size + 1) - size - 1 + of_key
    text = np.ones(int(size.sum()) + len(key) + len(new), np.int64)
    inside = np.repeat(at - np.cumsum(size) + size, size) + np.arange(size.sum())
    text[inside] = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64) + 2
    text[np.append(at[new[1:]], len(text)) - 1] = 0
    order = suffix_arrays(text, at[new])
    # strings of WINDOW bytes, in order
    strings = (meta & 63) + 1
    of = np.repeat(np.arange(len(key)), strings)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(strings) - strings, strings)
    number = np.full(len(text), -1)
    number[at[of] + nth] = np.arange(len(of))
    rank = number[order]
    rank = rank[rank >= 0]
    begin = at[of[rank]] + nth[rank]
    equal = of_key[of[rank][1:]] == of_key[of[rank][:-1]]
    for j in range(WINDOW):
        some = np.flatnonzero(equal)
        equal[some] = text[begin[some + 1] + j] == text[begin[some] + j]
    run = np.cumsum(np.concatenate(([True], ~equal))) - 1
    doc, start = o[of[rank]], (meta >> 16)[of[rank]] + nth[rank]
    place = np.lexsort((start, doc, run))
    first = np.flatnonzero(np.diff(run[place], prepend=-1))
    least = place[first][run]
    later = (doc != doc[least]) | (start != start[least])
    return merged(of[rank][later], start[later], start[later] + WINDOW)


def _sorted_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts in the order of their keys -> the ranges that go. A key's
    contexts may continue in the next batch."""
    rest: list[pa.RecordBatch] = []
    batches = (whole.slice(k, SORTED) for whole in batches for k in range(0, whole.num_rows, SORTED))

    def done(rows: pa.Table) -> pa.RecordBatch:
        key, o, t, meta = (rows.column(c).to_numpy() for c in ("key", "o", "t", "meta"))
        of, lo, hi = repeats(key, o, meta, rows.column("bytes").to_pylist())
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (o[of], t[of], lo, hi)], names=["o", "t", "lo", "hi"])

    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy()
        last = int(np.searchsorted(key, key[-1]))
        if last and rest:
            yield done(pa.Table.from_batches([*rest, batch.slice(0, last)]))
            rest = [batch.slice(last)]
        elif last:
            yield done(pa.Table.from_batches([batch.slice(0, last)]))
            rest = [batch.slice(last)]
        elif rest and rest[-1].column("key")[-1].as_py() != key[0]:
            yield done(pa.Table.from_batches(rest))
            rest = [batch]
        else:
            rest.append(batch)
    if rest:
        yield done(pa.Table.from_batches(rest))


def removed(docs: DataFrame) -> DataFrame:
    """docs (o, t, text) of at least WINDOW bytes each, o and t naming one ->
    the ranges (o, t, lo, hi) that go, of which some may overlap."""
    listed = docs.mapInArrow(_listed(_common(docs)), "goes boolean, key long, ctx long, o long, t long, meta long")
    met = stored(_met(listed, "ctx").where("goes OR later OR many > 1").drop("best").withColumn("open", F.expr("NOT goes AND NOT later")))
    out = [met.where("goes").selectExpr("o", "t", f"{_START} AS lo", "ctx AS hi"), met.where("later").selectExpr(*_GOES)]
    wanted = met.where("open").groupBy("o", "t").agg(F.collect_list(F.struct("key", "many", "meta")).alias("wanted"))
    found = stored(docs.join(wanted.hint("shuffle_hash"), ["o", "t"]).mapInArrow(_fetched, _CONTEXT))
    few = [found.where(f"many <= {MOST}")]
    for _ in CELLS[1:]:
        crowded = found.where(f"many > {MOST}")
        if not crowded.take(1):
            break
        part = _met(crowded.mapInArrow(_split, _CONTEXT).drop("many").withColumn("offset", F.expr(_OFFSET)), "offset", "bytes")
        found = stored(part.where("later OR many > 1"))
        out.append(found.where("later").selectExpr(*_GOES))
        found = found.where("NOT later").select("goes", "key", "many", "o", "t", "meta", "bytes")
        few.append(found.where(f"many <= {MOST} OR {_LEVEL} = {len(CELLS) - 1}"))
    for rows in few:
        dealt = rows.select("key", "o", "t", "meta", "bytes").repartition("key").sortWithinPartitions("key")
        out.append(dealt.mapInArrow(_sorted_out, "o long, t long, lo long, hi long"))
    whole = out[0]
    for rows in out[1:]:
        whole = whole.union(rows)
    return whole


_RANGES = ArrayType(StructType([StructField("lo", LongType()), StructField("hi", LongType())]))
ADDED = [StructField("removed", _RANGES), StructField("kept", BinaryType())]


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """All columns of docs (doc_id, text, ...), then removed (the ranges of
    bytes that go) and kept (the other bytes)."""
    docs = docs.drop("removed", "kept")
    own, of = unclashed(docs)
    text = of["text"]
    own = own.withColumn("o", F.coalesce(F.col(of["doc_id"]).cast("long"), F.lit((1 << 63) - 1))).withColumn("t", F.xxhash64(F.coalesce(text, F.lit(""))))
    goes = removed(own.where(F.octet_length(text) >= WINDOW).select("o", "t", F.col(text).alias("text")))
    goes = stored(goes.groupBy("o", "t").agg(F.collect_set(F.struct("lo", "hi")).alias("goes")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text):
            ranges, kept = [], []
            for raw, found in zip(batch.column(text).cast(pa.large_binary()).to_pylist(), batch.column("goes")):
                raw, spans, left, at = raw or b"", [], [], 0
                if found.is_valid and len(found.values):
                    lo, hi = (found.values.field(k).to_numpy() for k in (0, 1))
                    _, lo, hi = merged(np.zeros(len(lo), np.int64), lo, hi)
                    spans = [{"lo": a, "hi": b} for a, b in zip(lo.tolist(), hi.tolist())]
                for span in spans:
                    left.append(raw[at : span["lo"]])
                    at = span["hi"]
                ranges.append(spans)
                kept.append(b"".join([*left, raw[at:]]))
            kind = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in of.values()), pa.array(ranges, kind), pa.array(kept, pa.binary())], names=[*of.values(), "removed", "kept"])

    schema = StructType([*(own.schema[c] for c in of.values()), *ADDED])
    dealt = own.join(goes.hint("shuffle_hash"), ["o", "t"], "left").select(*of.values(), "goes")
    return dealt.mapInArrow(cut, schema).toDF(*docs.columns, "removed", "kept")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["hi"] - r["lo"])
    return found.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, strlen(coalesce(text, '')) AS n, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, x, unnest(range(0, n - 99)) AS s FROM d WHERE n >= 100),
h AS (SELECT doc_id, s, md5(substr(x, 2 * s + 1, 200)) AS h FROM w),
later AS (SELECT doc_id, s FROM h QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, s) > 1),
marked AS (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 0 ELSE 1 END AS new FROM later),
run AS (SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS k FROM marked),
span AS (SELECT doc_id, k, min(s) AS lo, max(s) + 100 AS hi FROM run GROUP BY 1, 2),
gap AS (SELECT doc_id, lo, hi, lag(hi, 1, 0) OVER (PARTITION BY doc_id ORDER BY lo) AS upto FROM span),
cut AS (
  SELECT g.doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans, max(hi) AS last,
         string_agg(substr(x, 2 * upto + 1, 2 * (lo - upto)), '' ORDER BY lo) AS head FROM gap g JOIN d USING (doc_id) GROUP BY 1)
SELECT d.doc_id, d.n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN n_removed IS NULL THEN x ELSE head || substr(x, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""
