"""Fill-in-middle, collocations and removal of repeats against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from normalake.llm import collocations, fill_in_middle, suffix_dedup
from normalake.llm._suffixes import suffix_arrays

LONG = "doc_id long, text string"


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# fill-in-middle


def brute_fim(doc_id, text):
    t = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", t, re.S)
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(tokens)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, t
    if h[3] % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def fim_cases():
    rng = random.Random(5)
    texts = [None, "", "a", "<", "a<P>b", "ab cd\nef", "é" * 9, "x" * 300, "1234567", "<P" * 20, "🙂a🙂b" * 30]
    texts += ["".join(rng.choice("abZ é\n.🙂<PSM>0") for _ in range(rng.randrange(120))) for _ in range(150)]
    return [(i, t) for i, t in enumerate(texts)] + [(None, "no id here"), (3, "ab cd again"), (5, "ab cd\nef"), (5, "ab cd\nef")]


@pytest.mark.parametrize("chunk,giant", [(1 << 16, 1 << 22), (7, 1 << 22), (7, 40)])
def test_fill_in_middle_cuts_at_tokens_whatever_the_chunks(spark, chunk, giant):
    cases = fim_cases()
    docs = spark.createDataFrame(cases, LONG)
    found = fill_in_middle.fill_in_middle(docs, chunk=chunk, giant=giant).select("doc_id", *fill_in_middle._KINDS)
    assert sorted(rows_of(found), key=repr) == sorted((brute_fim(*c) for c in cases), key=repr)


def test_fill_in_middle_restores_texts_and_keeps_other_columns(spark):
    docs = spark.createDataFrame([(i, t, i, "x") for i, t in fim_cases()], LONG + ", form long, `a.b` string")
    found = fill_in_middle.fill_in_middle(docs)
    assert found.columns == ["doc_id", "text", "a.b", *fill_in_middle._KINDS]
    assert found.withColumn("back", fill_in_middle.restored()).where("back IS DISTINCT FROM coalesce(text, '')").count() == 0
    assert fill_in_middle.fill_in_middle(docs.limit(0)).count() == 0


def test_chunks_compose_associatively():
    rng = np.random.default_rng(3)
    data = rng.choice(np.frombuffer("ab 1é".encode(), np.uint8), 60)
    parts = [fill_in_middle.summaries(data[a:b], np.array([[0, b - a]])) for a, b in ((0, 17), (17, 17), (17, 41), (41, 60))]
    a, b, c, d = parts
    left = fill_in_middle.composed(fill_in_middle.composed(fill_in_middle.composed(a, b), c), d)
    right = fill_in_middle.composed(a, fill_in_middle.composed(b, fill_in_middle.composed(c, d)))
    assert (left == right).all()
    assert left[0, 0, 1] == len(fill_in_middle.starts(data, 0)) and left[0, 1, 1] == len(fill_in_middle.starts(data, 1))


# collocations


def brute_collocations(rows, least, top):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = (text or "").translate({a: a + 32 for a in range(65, 91)})
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            ws = [w for w in re.split("[ \t]+", piece) if w]
            total[lang] += len(ws)
            for n in range(1, 6):
                for i in range(len(ws) - n + 1):
                    f[lang, tuple(ws[i : i + n])] += 1
    out = []
    for lang in sorted(total):
        found = []
        for (of, p), a in f.items():
            if of != lang or len(p) < 2 or a < least:
                continue
            longer = [q for (at, q), b in f.items() if at == lang and b >= least and len(q) > len(p) and b >= a]
            if any(q[i : i + len(p)] == p for q in longer for i in range(len(q) - len(p) + 1)):
                continue
            score, k = min((1000 * a * total[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return out


def phrase_cases():
    rng = random.Random(11)
    words = ["the", "of", "Été", "x1", "a\x0bb", "new", "york", "I", "-", "straße"]
    rows = [(None, None), ("en", ""), ("en", " \t ,;"), ("und", "new york"), ("en", "new  york\tcity new york city. New York City")]
    for _ in range(120):
        lang = rng.choice(["en", "en", "de", None])
        rows.append((lang, "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "?"]) for _ in range(rng.randrange(40)))))
    return rows


@pytest.mark.parametrize("least,top", [(3, 2000), (4, 7)])
def test_collocations_equal_brute_force(spark, least, top):
    rows = phrase_cases()
    docs = spark.createDataFrame([(l, t, 1) for l, t in rows], "lang string, text string, rank int").repartition(5)
    assert sorted(rows_of(collocations.collocations(docs, top, least))) == sorted(brute_collocations(rows, least, top))
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_phrases_are_counted_alike_in_blocks_of_any_size(monkeypatch):
    text = " ".join(random.Random(2).choice(["a", "bb", "ccc. d", "e" * 70]) for _ in range(400)) + "x" * 500
    every = collocations.Bloom(np.full(16, 0xFFFFFFFFFFFFFFFF, np.uint64))

    def found(step):
        out = Counter()
        for n, phrases, count in collocations.counted(pa.array([text, None, text]), "en", step, (every, every)):
            for p, c in zip(phrases.to_pylist(), count.tolist()):
                out[n, p] += c
        return out

    whole = [found(step) for step in (1, 2, 3)]
    for block in (16, 100, 1000):
        monkeypatch.setattr(collocations, "BLOCK", block)
        assert [found(step) for step in (1, 2, 3)] == whole


def test_a_bloom_filter_misses_nothing_and_is_bounded(spark):
    rows = spark.range(3000).selectExpr("'en' AS lang", "1 AS n", "concat('w', id) AS phrase", "100L AS f")
    found = collocations._bloom(rows, 1)
    h = collocations.grams(collocations._word_hashes(pa.array([f"w{i}" for i in range(6000)])), 1) + collocations._of_lang("en")
    got = found(h)
    assert got[:3000].all() and got[3000:].mean() < 0.05
    assert len(found.words) * 64 <= 32 * 3000


# removal of repeats


def brute_repeats(rows):
    docs = [((1 << 63) - 1 if d is None else d, (t or "").encode()) for d, t in rows]
    first = {}
    for d, b in docs:
        for s in range(len(b) - 99):
            k = b[s : s + 100]
            first[k] = min(first.get(k, (d, s)), (d, s))
    out = []
    for (d, b), (doc_id, _) in zip(docs, rows):
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - 99):
            if first[b[s : s + 100]] != (d, s):
                gone[s : s + 100] = True
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((doc_id, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def repeat_cases(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(k) for k in (8, 20, 20, 60, 150)]
    line = prose(40)[:85]
    rows = [(0, None), (1, ""), (2, "a" * 99), (3, "a" * 100), (4, "a" * 350), (5, "ab" * 200), (6, "\0" * 130), (7, "é" * 120)]
    for i in range(8, 120):
        parts = [prose(rng.randrange(40))]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(shared), prose(rng.randrange(6))]
        if i % 2:
            parts += ["\n" + line + "\n", prose(30)]
        rows.append((i * 7 - 300, "".join(parts)))
    rows += [(500 + i, rows[20][1]) for i in range(60)]
    rows += [(None, rows[30][1]), (None, shared[4] + "x"), (9000, shared[3] * 3), (9000, "y" + shared[3] * 2), rows[25], rows[25]]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_are_removed_as_by_brute_force(spark, seed):
    rows = repeat_cases(seed)
    docs = spark.createDataFrame(rows, LONG).repartition(7)
    found = suffix_dedup.suffix_dedup(docs)
    got = [(r.doc_id, len((r.text or "").encode()), sum(x.hi - x.lo for x in r.removed), len(r.removed), hashlib.sha256(r.kept).hexdigest()) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(brute_repeats(rows), key=repr)


def test_crowded_anchors_are_split_until_few_contexts_meet(spark, monkeypatch):
    rng = random.Random(4)
    line = "".join(rng.choice("abcdefgh ") for _ in range(97))
    rows = [(i, "".join(rng.choice("ijklmnop") for _ in range(60)) + line + "".join(rng.choice("qrst") for _ in range(3 + i % 60))) for i in range(200)]
    rows += [(1000 + i, line + "zz!" + str(i % 3)) for i in range(90)]
    monkeypatch.setattr(suffix_dedup, "_common", lambda docs: np.zeros(0, np.uint64))
    found = suffix_dedup.suffix_dedup(spark.createDataFrame(rows, LONG)).collect()
    got = [(r.doc_id, len(r.text), sum(x.hi - x.lo for x in r.removed), len(r.removed), hashlib.sha256(r.kept).hexdigest()) for r in found]
    assert sorted(got) == sorted(brute_repeats(rows))


def test_repeats_keep_other_columns_and_take_empty_tables(spark):
    docs = spark.createDataFrame([(1, "x" * 250, 5, "k"), (2, None, 6, "k")], LONG + ", kept long, `o` string")
    found = suffix_dedup.suffix_dedup(docs)
    assert found.columns == ["doc_id", "text", "o", "removed", "kept"]
    assert {r.doc_id: (r.o, [tuple(x) for x in r.removed], bytes(r.kept)) for r in found.collect()} == {1: ("k", [(1, 250)], b"x"), 2: ("k", [], b"")}
    assert suffix_dedup.suffix_dedup(docs.limit(0)).count() == 0


def test_buckets_may_continue_in_the_next_batch():
    raw = [b"a" * 50 + bytes([65 + i]) + b"b" * 60 for i in range(6)] + [b"q" * 111]
    rows = {"goes": [False] * 7, "key": [1, 1, 2, 2, 2, 2, 9], "o": list(range(7)), "t": [0] * 7, "meta": [10] * 7, "bytes": raw}
    whole = pa.RecordBatch.from_pydict(rows)
    alone = pa.concat_tables([pa.Table.from_batches([x]) for x in suffix_dedup._sorted_out(iter([whole]))]).to_pylist()
    for cut in range(1, 7):
        parts = [whole.slice(0, cut), whole.slice(0, 0), whole.slice(cut)]
        found = pa.concat_tables([pa.Table.from_batches([x]) for x in suffix_dedup._sorted_out(iter(parts))]).to_pylist()
        assert found == alone


def test_suffix_arrays_of_many_strings():
    rng = random.Random(8)
    strings = [[rng.randrange(1, 1 + rng.choice([1, 2, 4])) for _ in range(rng.randrange(40))] + [0] for _ in range(300)]
    strings += [[1, 2] * 30 + [0], [2, 1] * 30 + [0], [3] * 50 + [0], [0]]
    lo = np.cumsum([0] + [len(s) for s in strings])[:-1]
    found = suffix_arrays(np.array(sum(strings, [])), lo)
    for s, at in zip(strings, lo):
        assert (found[at : at + len(s)] - at).tolist() == sorted(range(len(s)), key=lambda i: s[i:])
