"""Phrase collocations of each language, counted exactly.

Method: all phrases of 1 to MOST words become rows (lang, phrase, occurrences),
summed by language and phrase; a candidate's cuts are joined with the counts of
their first and last part; scores are whole numbers in Decimal; a candidate is
dropped by an anti-join with the phrases that are one word longer (a longer
phrase that holds it as often implies one of these); a window ranks the rest.

A phrase occurs no oftener than its parts do, so rows come in three scans:
words, pairs of words that are frequent each, and longer phrases of which every
pair is frequent.  Membership is asked of a Bloom filter of at most BITS bits
(8 MB), so what goes to the tasks is bounded; a full filter lets more rows
through and changes no result.  Each batch of texts is counted before its rows
leave the task, by codes of words, not by hashes.  Very long texts are
counted in blocks.

Defined cases: a null text counts as empty; a null lang is ``und``, together
with rows whose lang is that; an empty table gives no rows.  Rows that repeat
count as often as they stand there.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from normalake.llm._bloom import BITS, Bloom, set_bits
from normalake.llm._skew import attached
from normalake.llm._text import Memo, grams, hashed_words, joined, small_batches
from normalake.sources.tables import stored

MOST, LEAST, TOP = 5, 100, 2000
BLOCK = 8 << 20
_U = np.uint64


@Memo
def _bytes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with A-Z lower-cased; which end a piece; which are of words."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    ends = np.zeros(256, bool)
    ends[[*b".,;:!?\n\x0b\x0c\r"]] = True
    word = ~ends
    word[[9, 32]] = False
    return lower, ends, word


def _blocks(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]]:
    """data in blocks that end after a word: its bytes, each word's start, end
    and piece, and how many words begin phrases here; the others, MOST - 1 but
    at the end, begin the next block."""
    lower, ends, word = _bytes()
    lo, n, size = 0, len(data), BLOCK
    while lo < n:
        hi = min(lo + size, n)
        if hi < n:
            hi = lo + last_gap(word[data[lo:hi]])
        part = lower[data[lo:hi]]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], word[part], [False])).view(np.int8)))
        s, e = edge[::2], edge[1::2]
        own = len(s) if hi == n else len(s) - MOST + 1
        if own <= 0 and hi < n:  # very long words, or none
            lo, size = (hi, BLOCK) if hi > lo and not len(s) else (lo, 2 * size)
            continue
        yield part, s, e, np.searchsorted(np.flatnonzero(ends[part]), s), own
        lo, size = (n if hi == n else lo + int(s[own])), BLOCK


def last_gap(member: np.ndarray) -> int:
    """How many bytes there are up to the last one outside words."""
    for back in (4096, len(member)):
        gap = np.flatnonzero(~member[-back:])
        if len(gap):
            return len(member) - min(back, len(member)) + int(gap[-1]) + 1
    return 0


def _coded(part: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A number for each word, and the words by number."""
    ends = np.concatenate(([0], np.cumsum(e - s)))
    packed = pa.py_buffer(part[np.repeat(s - ends[:-1], e - s) + np.arange(ends[-1])].tobytes())
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(s), [None, pa.py_buffer(ends.astype(np.int64)), packed]).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _of_lang(lang: str) -> np.uint64:
    return _U(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "big"))


def _word_hashes(phrases: pa.Array) -> np.ndarray:
    """The hashes of the words of all phrases, one after the other."""
    return hashed_words(joined(phrases)[0], "nonspace")[2]


def counted(texts: pa.Array, lang: str, step: int, frequent: tuple[Bloom, ...]) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(words in a phrase, phrases, their occurrences) of texts in one
    language: single words at step 1 (and the number of all words as those of
    an empty phrase), pairs of frequent words at step 2, at step 3 phrases of
    more words of which each pair is frequent."""
    salt = _of_lang(lang)
    for part, s, e, piece, own in _blocks(joined(texts)[0]):
        if not len(s):
            continue
        codes, words = _coded(part, s, e)
        if step == 1:
            count = np.bincount(codes[:own], minlength=len(words))
            some = np.flatnonzero(count)
            yield 0, pa.array([b""], pa.large_binary()), np.array([own])
            yield 1, words.take(pa.array(some)), count[some]
            continue
        hashes = _word_hashes(words)
        often = frequent[0](grams(hashes, 1) + salt)[codes]
        both = often[:-1] & often[1:] & (piece[:-1] == piece[1:])
        if step == 3:
            at = np.flatnonzero(both)
            both[at] = frequent[1](pair_hashes(hashes[codes[at]], hashes[codes[at + 1]]) + salt)
        start = np.flatnonzero(both[:own])
        number = codes[start]
        for n in range(2, 3 if step == 2 else MOST + 1):
            if n > 2:
                on = start + n - 2 < len(both)
                on[on] = both[start[on] + n - 2]
                start, number = start[on], number[on]
            if not len(start):
                break
            _, first, number, count = np.unique(number * len(words) + codes[start + n - 1], return_index=True, return_inverse=True, return_counts=True)
            if n > 2 or step == 2:
                own_words = [words.take(pa.array(codes[start[first] + j])) for j in range(n)]
                yield n, pc.binary_join_element_wise(*own_words, pa.scalar(b" ", pa.large_binary())), count


def pair_hashes(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """What grams() gives for words one and other."""
    return grams(np.stack((one, other), 1).ravel(), 2)[::2]


_ROWS = "lang string, n int, phrase string, f long"


def _phrases(docs: DataFrame, least: int, step: int, *frequent: Bloom) -> DataFrame:
    """(lang, n, phrase, f) of phrases with ``least`` occurrences, and those of
    the empty phrase at step 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", BLOCK):
            langs = batch.column("lang")
            for lang in pc.unique(langs).to_pylist():
                for n, phrases, count in counted(batch.column("text").filter(pc.equal(langs, lang)), lang, step, frequent):
                    m = len(phrases)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * m), pa.array(np.full(m, n, np.int32)), phrases.cast(pa.string()), pa.array(count.astype(np.int64))], names=["lang", "n", "phrase", "f"])

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text").mapInArrow(run, _ROWS)
    return stored(rows.groupBy("lang", "n", "phrase").agg(F.sum("f").alias("f")).where(f"f >= {least} OR n = 0"))


def _bloom(phrases: DataFrame, n: int) -> Bloom:
    """Of the phrases of n words, in about 16 bits each but BITS at most. Bits
    are set by tasks and put together by Spark; the filter comes to the driver."""
    many = phrases.where(F.col("n") == n)
    bits = min(BITS, max(1 << 10, 1 << (16 * many.count()).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            salt = np.array([_of_lang(x) for x in langs.dictionary.to_pylist()], _U)[langs.indices.to_numpy()] if len(langs) else np.zeros(0, _U)
            h = grams(_word_hashes(batch.column("phrase")), n)[::n] + salt
            place, words = set_bits(h, bits)
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(words)], names=["place", "bits"])

    return Bloom.of(many.select("lang", "phrase").mapInArrow(run, "place long, bits long"), bits)


def scored(counts: DataFrame) -> DataFrame:
    """counts (lang, n, phrase, f) with the words of each lang as those of the
    empty phrase -> lang, phrase, a, l, r, n, score of each candidate by its
    lowest-scoring cut."""
    parts = counts.where("n > 0").select(F.struct("lang", "phrase").alias("part"), "f")
    cuts = counts.where("n > 1").select("lang", "phrase", F.col("f").alias("a"), F.explode(F.expr("sequence(1, n - 1)")).alias("k"))
    cuts = cuts.withColumn("head", F.expr("substring_index(phrase, ' ', k)")).withColumn("part", F.struct("lang", F.col("head").alias("phrase")))
    cuts = attached(cuts, "part", "phrase", parts.withColumnRenamed("f", "l"))
    cuts = cuts.withColumn("part", F.struct("lang", F.expr("substring(phrase, char_length(head) + 2)").alias("phrase")))
    cuts = attached(cuts, "part", "phrase", parts.withColumnRenamed("f", "r"))
    whole = counts.where("n = 0").select("lang", F.col("f").alias("n"))
    big = lambda x: f"CAST({x} AS DECIMAL(38, 0))"
    score = F.expr(f"(CAST(1000 * {big('a')} * {big('n')} AS DECIMAL(38, 0))) div {big('l')} div {big('r')}")
    cuts = attached(cuts, "lang", "phrase", whole).withColumn("score", score)
    return cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST) -> DataFrame:
    """docs (lang, text) -> lang, rank, phrase, a, l, r, n, score."""
    words = _phrases(docs, least, 1)
    one = _bloom(words, 1)
    pairs = _phrases(docs, least, 2, one)
    longer = _phrases(docs, least, 3, one, _bloom(pairs, 2))
    counts = words.unionByName(pairs).unionByName(longer)
    # what a phrase of one word more holds as often
    within = longer.select("lang", F.col("f").alias("a"), F.explode(F.expr("array(substring(phrase, instr(phrase, ' ') + 1), substring_index(phrase, ' ', n - 1))")).alias("phrase"))
    kept = scored(counts).join(within, ["lang", "phrase", "a"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[ 	]+'), lambda x: x <> '') AS ws FROM pieces),
rows_ AS (
  SELECT lang, m, array_to_string(ws[i : i + m - 1], ' ') AS phrase
  FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS m))),
total AS (SELECT lang, count(*) AS n FROM rows_ WHERE m = 1 GROUP BY 1),
f AS (SELECT lang, m, phrase, count(*) AS f FROM rows_ GROUP BY 1, 2, 3 HAVING count(*) >= 100),
cuts AS (
  SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws, unnest(range(1, m)) AS k FROM f WHERE m > 1),
scores AS (
  SELECT c.lang, c.m, c.phrase, c.a, c.k, l.f AS l, r.f AS r, t.n,
         (1000::HUGEINT * c.a * t.n // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1 : c.k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[c.k + 1 : c.m], ' ')
  JOIN total t ON t.lang = c.lang),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (
  SELECT * FROM lowest c WHERE NOT EXISTS (
    SELECT 1 FROM f x WHERE x.lang = c.lang AND x.m > c.m AND 100 * x.f >= 100 * c.a
      AND contains(' ' || x.phrase || ' ', ' ' || c.phrase || ' '))),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
