"""Benchmark decontamination by canonical templates.

Method: texts become words (letters, digits; lower case, sharp s as ss) and
their canonical form, in which numbers, unit words and names (a capitalised
word within a sentence) are typed placeholders.  Windows of WINDOW words are
hash-joined as they are and in canonical form, the latter also with each run
of numbers or names as one placeholder, and with capitalised words that begin
a sentence as names.  Matches of one item whose diagonals (text position less
item position) differ by no more than the item's length belong to one
occurrence: bands of twice that width, each overlapping the next by half.  A
word has one place, so one passage does not count for each of its repeats.
Plain matches always count.  Over the occurrence each slot value of the item
should have one value in the text and the other way round: slot words that
break this are not counted as covered, and where one was changed, canonical
matches over it and those that overlap them are left out.  A document is
contaminated by an item if an occurrence covers at least COVER of its words.

Documents are judged where they are read, by an index of the items' windows that
goes to the tasks, if the items have up to MAX_CHARS characters (their number is
checked); there is no shuffle.  The windows of a larger benchmark are rows: a
Bloom filter of bounded size (8 MB) lets through the documents' windows that may
be an item's, these are joined by hash under salted keys, and each pair of a
text and an item that meet is judged as above, in groups of about TOGETHER items.
Either way a row's text alone decides which items it holds.

Defined cases: items with fewer than SHORTEST words match nothing; items with
fewer than WINDOW words are one window as long as they are.  A canonical
window that is all placeholders is not used.  Null texts have no words.
Items without item_id are left out.  Each row is judged by itself, so rows that
repeat a doc_id or have none stay or go by their own text.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from normalake.llm._bloom import BITS, Bloom, set_bits
from normalake.llm._skew import SALTS, attached, salt, unclashed
from normalake.llm._text import grams, hash_of, hashed_words, joined, mix, small_batches, word_ranges
from normalake.sources.tables import dropped, stored

WINDOW, SHORTEST, COVER = 8, 5, 0.5
MAX_CHARS = 4_000_000
#: Items that a text is judged by at a time, if the benchmark is large.
TOGETHER = 64
UNITS = (
    "mm cm km m mg g kg lb lbs oz ml l litre litres liter liters inch inches foot feet yard yards mile miles "
    "second seconds minute minutes hour hours day days week weeks month months year years "
    "dollar dollars cent cents euro euros pound pounds percent degree degrees"
).split()
#: The hashes that stand for a number, a unit and a name.
PLACEHOLDERS = (np.uint64(0x1111), np.uint64(0x2222), np.uint64(0x3333))


def words_of(texts: pa.Array) -> dict:
    """The words of all texts: hashes, canonical hashes, and where each text's
    words start."""
    folded = pc.replace_substring(pc.utf8_lower(texts.cast(pa.large_string())), "ß", "ss")
    data, at = joined(folded)
    starts, ends, plain = hashed_words(data, "word")
    canon = plain.copy()
    digit = (data >= 48) & (data <= 57)
    number = np.zeros(len(plain), bool)
    if len(plain):
        many = np.concatenate(([0], np.cumsum(digit)))
        number = many[ends] - many[starts] == ends - starts
    unit = np.isin(plain, hash_of(UNITS))
    capital, begins = _names(texts, len(plain))
    kind = np.where(number, 1, np.where(unit, 2, np.where(capital & ~begins, 3, 0)))
    canon[kind > 0] = np.array(PLACEHOLDERS)[kind[kind > 0] - 1]
    return {"plain": plain, "canon": canon, "first": word_ranges(starts, at), "kind": kind, "starter": capital & begins & (kind == 0), "begins": begins}


def _names(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Words with an ASCII capital first and a lower-case letter next, and
    words that begin a sentence. Folding keeps the words' number and order."""
    data, _ = joined(texts)
    starts, ends, _ = hashed_words(data, "word")
    if len(starts) != n or not n:
        return np.zeros(n, bool), np.zeros(n, bool)
    nxt = data[np.minimum(starts + 1, len(data) - 1)]
    capital = (data[starts] >= 65) & (data[starts] <= 90) & (ends - starts > 1) & (((nxt >= 97) & (nxt <= 122)) | (nxt >= 128))
    stop = np.zeros(256, bool)
    stop[[10, 13, 33, 46, 58, 63]] = True
    number = np.concatenate(([0], np.cumsum(stop[data])))[starts]
    return capital, np.diff(number, prepend=-1) != 0


def _runs(words: dict, kind: np.ndarray) -> dict:
    """Each run of number words, or of names within a sentence, as one token."""
    plain, n = words["plain"], len(kind)
    edge = np.zeros(n + 1, bool)
    edge[words["first"]] = True
    more = np.zeros(n, bool)
    more[1:] = (kind[1:] == kind[:-1]) & ((kind[1:] == 1) | (kind[1:] == 3) & ~words["begins"][1:])
    start = np.flatnonzero(~(more & ~edge[:-1]))
    many = np.diff(start, append=n)
    if n:
        at = np.arange(n) - np.repeat(start, many)
        val = mix(np.add.reduceat(plain * np.power(np.uint64(0xC2B2AE3D27D4EB4F), at.astype(np.uint64)), start))
    else:
        val = plain
    val = np.where(many > 1, val, plain[start])
    key = val.copy()
    key[kind[start] > 0] = np.array(PLACEHOLDERS)[kind[start][kind[start] > 0] - 1]
    return {"key": key, "start": start, "n": many, "val": val, "slot": kind[start] > 0}


def streams(words: dict) -> list[dict]:
    """The token streams whose windows are matched: of each token its key, first
    word, number of words, value and whether it is a slot; of the last two, also
    which tokens make a window worth having. The first is plain. A word's value
    is that of its run, as '1' of '1,250' may well have two values."""
    plain, canon, kind = words["plain"], words["canon"], words["kind"]
    runs, named = _runs(words, kind), _runs(words, np.where(words["starter"], 3, kind))
    both = {"start": np.arange(len(plain)), "n": np.ones(len(plain), np.int64), "val": np.repeat(runs["val"], runs["n"]), "slot": kind > 0}
    return [{"key": plain, **both}, {"key": canon, **both}, {**runs, "need": runs["n"] > 1}, {**named, "need": words["starter"][named["start"]]}]


def windows(words: dict, stream: dict, size: int, canonical: bool) -> tuple[np.ndarray, np.ndarray]:
    """The first tokens of the usable windows, and their hashes."""
    start, first = stream["start"], words["first"]
    m = max(0, len(start) - size + 1)
    text = np.searchsorted(first, start, side="right")
    use = text[:m] == text[size - 1 : size - 1 + m]
    h = grams(stream["key"], size)
    if canonical:
        slots = np.concatenate(([0], np.cumsum(stream["slot"])))
        many = slots[size : size + m] - slots[:m]
        use &= (many > 0) & (many < size)
        if "need" in stream:
            need = np.concatenate(([0], np.cumsum(stream["need"])))
            use &= need[size : size + m] > need[:m]
        h ^= np.uint64(0x5A5A5A5A)  # a canonical hash never equals a plain one
    at = np.flatnonzero(use)
    return at, h[at]


def tokens_in(words: dict, stream: dict) -> np.ndarray:
    """The number of the stream's tokens in each text."""
    return np.diff(np.searchsorted(stream["start"], words["first"]))


class Index:
    """The windows of all items."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = np.array([i for i, _ in items], np.int64)
        words = words_of(pa.array([t for _, t in items], pa.string()))
        self.first = words["first"]
        self.length = np.diff(self.first)
        self.streams = streams(words)
        got: dict[int, list] = {}
        for k, stream in enumerate(self.streams):
            many = tokens_in(words, stream)
            for size in range(SHORTEST, WINDOW + 1):
                at, h = windows(words, stream, size, k > 0)
                item = np.searchsorted(self.first, stream["start"][at], side="right") - 1
                use = np.minimum(many[item], WINDOW) == size
                if use.any():
                    got.setdefault(size, []).append((h[use], at[use], np.full(use.sum(), k)))
        self.by_size = {}
        for size, parts in got.items():
            key, at, kind = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(key, kind="stable")
            key, at, kind = key[order], at[order], kind[order]
            seen = np.zeros(1 << 16, bool)
            seen[(key >> np.uint64(48)).astype(np.int64)] = True
            self.by_size[size] = key, at, kind, seen

    def matches(self, words: dict) -> dict[tuple[int, int], float]:
        """{(text, item): the largest share that an occurrence covers}."""
        theirs, found = streams(words), []
        for size, (key, at, kind, seen) in self.by_size.items():
            for k, stream in enumerate(theirs):
                t, values = windows(words, stream, size, k > 0)
                maybe = seen[(values >> np.uint64(48)).astype(np.int64)]
                t, values = t[maybe], values[maybe]
                lo, hi = np.searchsorted(key, values), np.searchsorted(key, values, side="right")
                many = hi - lo
                if many.sum():
                    where = np.repeat(lo, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    found.append((np.repeat(t, many), np.full(len(where), k), at[where], kind[where], np.full(len(where), size)))
        if not found:
            return {}
        t, tk, i, ik, size = (np.concatenate(x) for x in zip(*found))
        q, p, pe = np.zeros(len(t), np.int64), np.zeros(len(t), np.int64), np.zeros(len(t), np.int64)
        for k, (mine, its) in enumerate(zip(self.streams, theirs)):
            q[tk == k] = its["start"][t[tk == k]]
            p[ik == k] = mine["start"][i[ik == k]]
            last = (i + size - 1)[ik == k]
            pe[ik == k] = mine["start"][last] + mine["n"][last]
        text = np.searchsorted(words["first"], q, side="right") - 1
        item = np.searchsorted(self.first, p, side="right") - 1
        q, p, pe = q - words["first"][text], p - self.first[item], pe - self.first[item]
        frame = pd.DataFrame({"text": text, "item": item, "length": self.length[item], "q": q, "p": p, "pe": pe, "t": t, "tk": tk, "i": i, "ik": ik, "size": size})
        frame = enough(in_bands(frame), ["text", "item", "band"])
        out: dict[tuple[int, int], float] = {}
        for (x, y, _), g in frame.groupby(["text", "item", "band"], sort=False):
            listed = []
            for t, tk, i, ik, size in zip(g["t"], g["tk"], g["i"], g["ik"], g["size"]):
                a, b = self.streams[ik], theirs[tk]
                a, b = ({c: s[c][at : at + size] for c in ("start", "n", "val", "slot")} for s, at in ((a, i), (b, t)))
                listed.append((kind_of(ik, tk), a["start"] - self.first[y], a["n"], b["start"] - words["first"][x], b["n"], a["val"], b["val"], a["slot"], b["slot"]))
            share = covered(int(self.length[y]), listed)
            if share >= COVER:
                out[x, y] = max(out.get((x, y), 0.0), share)
        return out


def kind_of(ours: int, theirs: int) -> int:
    """By the two streams: 0 for a plain match, 1 for a canonical one, 2 for one
    with a name that begins a sentence."""
    return (0, 1, 1, 2)[max(ours, theirs)]


def in_bands(frame: pd.DataFrame) -> pd.DataFrame:
    """Each match with both occurrences it belongs to."""
    band = (frame["q"] - frame["p"]) // frame["length"]
    return pd.concat((frame.assign(band=band), frame.assign(band=band - 1)), ignore_index=True)


def enough(frame: pd.DataFrame, by: list[str]) -> pd.DataFrame:
    """The groups whose matches span at least COVER of the item's words."""
    frame = frame.sort_values([*by, "p", "pe"])
    group = frame.groupby(by, sort=False)
    before = frame.assign(top=group["pe"].cummax()).groupby(by, sort=False)["top"].shift(fill_value=0)
    new = (frame["pe"] - np.maximum(frame["p"], before)).clip(lower=0)
    return frame[new.groupby([frame[k] for k in by]).transform("sum") >= COVER * frame["length"]]


def covered(length: int, listed: list[tuple]) -> float:
    """The share of the item's words that the matches of one occurrence cover.
    A match: kind; of the item's tokens first word and number of words; the
    same of the text's; values of both; slots of both. An item word has one
    place in the text and the other way round; the longest diagonals go first."""
    to, used, counted = np.full(length, -1), set(), np.zeros(length, bool)
    slots: dict[int, tuple[int, int]] = {}
    lines: dict[int, list] = {}
    for x in listed:
        if x[0] == 0:
            lines.setdefault(int(x[3][0] - x[1][0]), []).append(x)
    words = {off: {int(p): (int(a), int(b) if s else int(a), bool(o)) for x in line for p, a, b, o, s in zip(x[1], x[5], x[6], x[7], x[8])} for off, line in lines.items()}
    for off in sorted(words, key=lambda k: (-len(words[k]), k)):
        for p, (a, b, slot) in words[off].items():
            if to[p] < 0 and p + off not in used:
                to[p], counted[p] = p + off, True
                used.add(p + off)
                if slot:
                    slots[p] = a, b
    chosen = [x for x in _in_order(listed, 1) if _placed(x, to, used)]
    pairs = set(slots.values()) | {y for x in chosen for y in _pairs(x)}
    ours, theirs = Counter(a for a, _ in pairs), Counter(b for _, b in pairs)
    broken = {(a, b) for a, b in pairs if ours[a] > 1 or theirs[b] > 1}
    doubt, drop = np.zeros(length, bool), np.zeros(length, bool)
    for x in chosen:
        if any(y in broken and y[0] != y[1] for y in _pairs(x)):
            doubt[_span(x)] = True
    for x in chosen:
        if not doubt[_span(x)].any():
            counted[_span(x)] = True
            for p, n, a, b, slot in zip(x[1], x[2], x[5], x[6], x[7]):
                drop[p : p + n] |= bool(slot) and (int(a), int(b)) in broken
    drop[[p for p, y in slots.items() if y in broken]] = True
    for x in _in_order(listed, 2):
        new = _pairs(x) - pairs
        one = len({a for a, _ in new}) == len({b for _, b in new}) == len(new)
        if one and not any(ours[a] or theirs[b] for a, b in new) and not doubt[_span(x)].any() and not _pairs(x) & broken and _placed(x, to, used):
            counted[_span(x)] = True
            pairs |= new
            ours.update(a for a, _ in new)
            theirs.update(b for _, b in new)
    return float((counted & ~drop).sum() / length)


def _span(x: tuple) -> slice:
    return slice(int(x[1][0]), int(x[1][-1] + x[2][-1]))


def _pairs(x: tuple) -> set[tuple[int, int]]:
    return {(int(a), int(b)) for a, b, slot in zip(x[5], x[6], x[7]) if slot}


def _in_order(listed: list[tuple], kind: int) -> list[tuple]:
    """The matches of a kind, those of the fullest diagonals first."""
    off = lambda x: int(x[3][0] - x[1][0])
    some = [x for x in listed if x[0] == kind]
    many = Counter(map(off, some))
    return sorted(some, key=lambda x: (-many[off(x)], off(x), int(x[1][0]), len(x[1]), tuple(map(int, x[2])), tuple(map(int, x[4]))))


def _placed(x: tuple, to: np.ndarray, used: set[int]) -> bool:
    """Give the words of a canonical match their places, unless it is not equal
    outside slots or a word has or is another's place."""
    if not np.array_equal(x[5][~x[7]], x[6][~x[7]]):
        return False
    new = {}
    for p, n, q, m in zip(*(map(int, x[k]) for k in (1, 2, 3, 4))):
        for j in range(n):
            place = q + min(j, m - 1)
            if to[p + j] != place:
                if to[p + j] >= 0 or place in used:
                    return False
                new[p + j] = place
    to[list(new)] = list(new.values())
    used.update(new.values())
    return True


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text")


def _index(benchmark: DataFrame, most: int) -> Index | None:
    """All items, or None if they have more than ``most`` characters."""
    items = _items(benchmark)
    total = items.agg(F.sum(F.char_length("text").cast("long"))).collect()[0][0] or 0
    return Index(sorted((r.item_id, r.text) for r in items.collect())) if total <= most else None


def _all_windows(words: dict, of_items: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, hash) of the windows of some texts. An item has those of WINDOW
    words, or of all if it has fewer; a document may hold any of these sizes."""
    for k, stream in enumerate(streams(words)):
        many = tokens_in(words, stream)
        for size in range(SHORTEST, WINDOW + 1):
            at, h = windows(words, stream, size, k > 0)
            text = np.searchsorted(words["first"], stream["start"][at], side="right") - 1
            use = np.minimum(many[text], WINDOW) == size if of_items else np.ones(len(at), bool)
            yield text[use], mix(h[use] + np.uint64(size))


def _windows_of(rows: DataFrame, key: str, bloom: Bloom | None) -> DataFrame:
    """rows (key, text) -> (key, w): the hashes of windows, of items, or of
    documents where a filter is given: those that pass it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            words = words_of(batch.column("text"))
            for text, h in _all_windows(words, bloom is None):
                ok = np.ones(len(h), bool) if bloom is None else bloom(h)
                pairs = pd.DataFrame({"t": text[ok], "w": h[ok].view(np.int64)}).drop_duplicates()
                yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(pairs["t"].to_numpy())), pa.array(pairs["w"].to_numpy())], names=[key, "w"])

    return rows.select(key, "text").mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, w long")


def _bloom(windows_: DataFrame) -> Bloom:
    """Of the window hashes, in about 16 bits each but BITS at most."""
    bits = min(BITS, max(1 << 10, 1 << (16 * windows_.count()).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, words = set_bits(batch.column("w").to_numpy().view(np.uint64), bits)
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(words)], names=["place", "bits"])

    return Bloom.of(windows_.select("w").mapInArrow(run, "place long, bits long"), bits)


def _joined(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, item_id, coverage, text_sha256, by a join
    of windows. Equal texts are judged once."""
    items = stored(_items(benchmark).withColumn("i", F.xxhash64("item_id", "text")))
    theirs = stored(_windows_of(items, "i", None).distinct())
    named = docs.where("text IS NOT NULL").withColumn("sha", F.sha2(F.col("text").cast("binary"), 256))
    hits = stored(_windows_of(named, "sha", _bloom(theirs)).distinct())
    pairs = stored(attached(hits, "w", "sha", theirs).select("sha", "i").distinct())
    parts = pairs.groupBy("sha").agg(F.expr(f"CAST(ceil(count(*) / {TOGETHER}) AS INT)").alias("parts"))
    dealt = attached(pairs, "sha", "i", parts).withColumn("c", F.pmod(F.xxhash64("i"), F.col("parts")))
    wanted = attached(dealt.select("sha", "i", "c"), "i", "sha", items.withColumnRenamed("text", "item"))
    groups = wanted.groupBy("sha", "c").agg(F.collect_list(F.struct("item_id", "item")).alias("items"))
    texts = named.join(parts.select("sha").hint("shuffle_hash"), "sha", "left_semi").groupBy("sha").agg(F.first("text").alias("text"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            out = []
            for sha, text, own in zip(*(batch.column(c) for c in ("sha", "text", "items"))):
                index = Index(sorted((x["item_id"], x["item"]) for x in own.as_py()))
                found = index.matches(words_of(pa.array([text.as_py()], pa.large_string())))
                out += [(sha.as_py(), int(index.ids[i]), float(share)) for (_, i), share in found.items()]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.string(), pa.int64(), pa.float64()))], names=["sha", "item_id", "coverage"])

    judged = stored(texts.join(groups, "sha").mapInArrow(judge, "sha string, item_id long, coverage double"))
    dropped(theirs, hits, pairs, items)
    return attached(named.select("doc_id", "sha"), "sha", "doc_id", judged).select("doc_id", "item_id", "coverage", F.col("sha").alias("text_sha256"))


def _matched(docs: DataFrame, index: Index) -> DataFrame:
    """docs (doc_id, text) -> doc_id, item_id, coverage, text_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            found = index.matches(words_of(batch.column("text")))
            rows = pa.array([t for t, _ in found], pa.int64())
            shas = [hashlib.sha256(x.as_py().encode()).hexdigest() for x in batch.column("text").take(rows)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(rows), pa.array(index.ids[[i for _, i in found]] if found else [], pa.int64()), pa.array(list(found.values()), pa.float64()), pa.array(shas, pa.string())], names=["doc_id", "item_id", "coverage", "text_sha256"])

    return docs.mapInArrow(run, "doc_id long, item_id long, coverage double, text_sha256 string")


def leaks(docs: DataFrame, benchmark: DataFrame, most: int = MAX_CHARS) -> DataFrame:
    """docs (doc_id, text), benchmark (item_id, text) -> doc_id, item_id,
    coverage: one row for each contaminated row and item."""
    return _leaks(docs, benchmark, most).drop("text_sha256")


def _leaks(docs: DataFrame, benchmark: DataFrame, most: int) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    index = _index(benchmark, most)
    return _joined(docs, benchmark) if index is None else _matched(docs, index)


def clean(docs: DataFrame, benchmark: DataFrame, most: int = MAX_CHARS) -> DataFrame:
    """The rows of docs, in their columns, that no item contaminates. What a
    row's text holds decides, so rows of equal text stay or go together."""
    index = _index(benchmark, most)
    if index is None:
        own, of = unclashed(docs)
        bad = _joined(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark).select("text_sha256").distinct().withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        same = (F.sha2(F.col(of["text"]).cast("binary"), 256) == F.col("text_sha256")) & (salt(of["doc_id"]) == F.col("s"))
        return own.join(bad, same, "left_anti").toDF(*docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            bad = {t for t, _ in index.matches(words_of(batch.column("text")))}
            yield batch.filter(pa.array([i not in bad for i in range(batch.num_rows)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
