"""License scans by a positional index of rare words.

Method: the licence passages (TEMPLATES) are indexed by their rarest positions,
those of highest inverse document frequency over all documents, with their
postings (passage, position).  Each licence word of a file votes for the places
at which its passages would start.  Places that differ by less than SLACK agree,
so words put in or left out do not part the votes.  A passage is accepted at a
place if COVER of its words stand there, each within the slack, and each of its
mandatory key phrases stands there word for word.  The score is the largest
accepted share of words.

Two filters lose nothing.  Key phrases are found first, and only passages whose
phrases a text has are looked up in it.  Of a passage's rarest positions so many
are indexed that any place with COVER of all its words has VOTES of these.

Base places (a phrase's words standing consecutively) are found on the same
word hashes; their labels stay, with score 1.

Words: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the text with A-Z
lower-cased.  Defined cases: a null text counts as empty and has no words; with
no base place first_word and last_word are null.  Document frequencies are
counted over all rows; an empty table gives no rows.  Columns of docs with the
names of the result's are replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from normalake.llm._text import hash_of, hashed_words, joined, small_batches, word_ranges

SLACK, VOTES, COVER = 4, 3, 0.7
#: Passages that a table may give.
MOST_TEMPLATES = 10_000
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
#: label, passage of the licence or of its usual notice, mandatory key phrases (all must stand there)
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0", ("apache license",)),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http www apache org licenses LICENSE 2.0", ("except in compliance with the license", "apache org licenses")),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.", ("warranties or conditions of any kind", "language governing permissions and limitations")),
    ("mit", "Released under the MIT License", ("mit license",)),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so", ("deal in the software without restriction", "use copy modify merge publish distribute sublicense")),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted", "software and associated documentation files")),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.", ("copies or substantial portions of the software",)),
    ("gpl", "This work is licensed under the GNU General Public License, version 3", ("gnu general public license",)),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License", ("gnu general public license",)),
    ("gpl", "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.", ("gnu general public license for more details",)),
    ("lgpl", "licensed under the GNU Lesser General Public License", ("gnu lesser general public license",)),
    ("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", ("gnu lesser general public license",)),
    ("agpl", "licensed under the GNU Affero General Public License", ("gnu affero general public license",)),
    ("agpl", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation", ("gnu affero general public license",)),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license",)),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", ("redistributions of source code must retain",)),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.", ("redistributions in binary form must reproduce",)),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", ("with or without fee is hereby granted", "distribute this software for any purpose")),
    ("zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions", ("to alter it and redistribute it freely",)),
    ("unlicense", "This is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    ("cc-by", "Licensed under CC BY 4.0", ("cc by 4 0",)),
    ("cc-by", "Licensed under CC BY 3.0", ("cc by 3 0",)),
    ("cc-by", "Licensed under CC BY 2.0", ("cc by 2 0",)),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution 4 0",)),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 3.0 Unported License", ("creative commons attribution 3 0",)),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", ("cc by sa",)),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License", ("creative commons attribution sharealike",)),
    ("cc0", "CC0 1.0 Universal Public Domain Dedication", ("cc0 1 0",)),
)


def words(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate({a: a + 32 for a in range(65, 91)}))


def vocabulary(templates=TEMPLATES) -> list[str]:
    return sorted({w for _, text, _ in templates for w in words(text)})


class _Lookup:
    """Positions of some words among many."""

    def __init__(self, vocab: list[str]):
        h = hash_of(vocab)
        self.order = np.argsort(h)
        self.h = h[self.order]
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(h >> np.uint64(48)).astype(np.int64)] = True

    def __call__(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where words of the vocabulary stand, and which."""
        at = np.flatnonzero(self.seen[(found >> np.uint64(48)).astype(np.int64)])
        k = np.minimum(np.searchsorted(self.h, found[at]), len(self.h) - 1)
        same = self.h[k] == found[at]
        return at[same], self.order[k[same]]


def document_frequencies(docs: DataFrame, templates=TEMPLATES) -> tuple[int, dict[str, int]]:
    """Number of documents, and of those with each vocabulary word."""
    vocab = vocabulary(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, count, n = _Lookup(vocab), np.zeros(len(vocab), np.int64), 0
        for batch in small_batches(batches, "text"):
            data, at = joined(batch.column("text"))
            starts, _, h = hashed_words(data, "word")
            where, which = lookup(h)
            doc = np.searchsorted(word_ranges(starts, at), where, side="right") - 1
            count += np.bincount(np.unique(doc * len(vocab) + which) % len(vocab), minlength=len(vocab))
            n += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(vocab))), pa.array(np.concatenate(([n], count)))], names=["word", "df"])

    rows = docs.select("text").mapInArrow(run, "word long, df long").groupBy("word").agg(F.sum("df").alias("df")).collect()  # one row a vocabulary word
    got = {r.word: r.df for r in rows}
    return got.get(-1, 0), {w: got.get(i, 0) for i, w in enumerate(vocab)}


class Index:
    def __init__(self, n: int, df: dict[str, int], templates=TEMPLATES, phrases=PHRASES):
        self.vocab = vocabulary(templates)
        idf = np.array([math.log((n + 1) / (df.get(w, 0) + 1)) for w in self.vocab])
        #: each word's place among all, the highest inverse document frequency first
        self.place = np.empty(len(self.vocab), np.int64)
        self.place[np.argsort(-idf, kind="stable")] = np.arange(len(self.vocab))
        number = {w: k for k, w in enumerate(self.vocab)}
        self.templates, self.needed, posted = [], [], []
        keys: dict[str, int] = {}
        for t, (label, text, phrases_of) in enumerate(templates):
            own = words(text)
            self.templates.append((label, hash_of(own), [keys.setdefault(" ".join(words(k)), len(keys)) for k in phrases_of]))
            # of any COVER of the positions, VOTES are among these
            need = max(VOTES, math.ceil(COVER * len(own) - 1e-9))
            rare = sorted(range(len(own)), key=lambda q: (self.place[number[own[q]]], q))[: len(own) - need + VOTES]
            self.needed.append(need)
            posted += [(number[own[q]], t, q) for q in rare]
        posted.sort()
        self.keys = [hash_of(k.split(" ")) for k in keys]
        self.post_t, self.post_q = np.array([t for _, t, _ in posted], np.int64), np.array([q for _, _, q in posted], np.int64)
        self.post_at = np.searchsorted(np.array([w for w, _, _ in posted], np.int64), np.arange(len(self.vocab) + 1))
        self.lookup = _Lookup(self.vocab)
        self.phrases = [(hash_of(words(p)), label) for p, label in phrases]

    def possible(self, h: np.ndarray, first: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Where each key phrase stands, and whether text d has all those of
        passage t: (texts, passages)."""
        places, n = [], len(first) - 1
        there = np.zeros((n, len(self.keys)), bool)
        for k, phrase in enumerate(self.keys):
            at = _standing(h, phrase)
            doc = np.searchsorted(first, at, side="right") - 1
            inside = at + len(phrase) <= first[doc + 1]
            places.append(at[inside])
            there[doc[inside], k] = True
        return places, np.stack([there[:, keys].all(1) for _, _, keys in self.templates], 1)

    def candidates(self, h: np.ndarray, first: np.ndarray, possible: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, passage and place where VOTES of the passage's rarest
        positions agree on a place from there to SLACK words on."""
        texts = np.flatnonzero(possible.any(1))
        part, at = _within(first, texts)
        where, which = self.lookup(h[at]) if len(at) else (at, at)
        doc, where = part[where], at[where]
        many = self.post_at[which + 1] - self.post_at[which]
        post = np.repeat(self.post_at[which], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        doc, t, q, place = np.repeat(doc, many), self.post_t[post], self.post_q[post], (np.repeat(where, many) - self.post_q[post]) // SLACK
        ok = possible[doc, t]
        doc, t, q, place = (x[ok] for x in (doc, t, q, place))
        if not len(doc):
            return doc, t, place
        doc, t, q, place = np.tile(doc, 2), np.tile(t, 2), np.tile(q, 2), np.concatenate((place, place - 1))
        # one number for (text, passage, place, position)
        low, ts, qs = int(place.min()), len(self.templates), int(q.max()) + 1
        span = int(place.max()) - low + 1
        votes = np.unique(((doc * ts + t) * span + place - low) * qs + q)
        found, count = np.unique(votes // qs, return_counts=True)
        found = found[count >= VOTES]
        return found // span // ts, found // span % ts, (found % span + low) * SLACK

    def accepted(self, h: np.ndarray, first: np.ndarray) -> list[tuple[int, str, float]]:
        """(text, label, share) of the passages that are there."""
        places, possible = self.possible(h, first)
        out = []
        doc, which, start = self.candidates(h, first, possible) if possible.any() else (np.zeros(0, np.int64),) * 3
        for t in np.unique(which):
            label, own, keys = self.templates[t]
            at = np.flatnonzero(which == t)
            d, begin = doc[at], start[at]
            lo, hi = np.maximum(begin, first[d]), np.minimum(begin + len(own) + 2 * SLACK, first[d + 1])
            ok = np.ones(len(at), bool)
            for k in keys:  # the first of its places from lo on must end by hi
                next_ = np.searchsorted(places[k], lo)
                ok &= next_ < len(places[k])
                ok[ok] = places[k][next_[ok]] + len(self.keys[k]) <= hi[ok]
            d, begin = d[ok], begin[ok]
            for part in range(0, len(d), 1 << 12):
                e, b = d[part : part + (1 << 12)], begin[part : part + (1 << 12)]
                share = self.covered(h, first[e], first[e + 1], t, b)
                out += [(int(x), label, float(y)) for x, y in zip(e[share >= self.needed[t]], share[share >= self.needed[t]] / len(own))]
        return out

    def covered(self, h: np.ndarray, lo: np.ndarray, hi: np.ndarray, t: int, start: np.ndarray) -> np.ndarray:
        """How many of the passage's words stand in words lo to hi at their
        place from start, within twice the slack: for many places at once."""
        own, found = self.templates[t][1], np.zeros(len(start), np.int64)
        for q, word in enumerate(own):
            at = start[:, None] + q + np.arange(2 * SLACK)
            inside = (at >= lo[:, None]) & (at < hi[:, None])
            found += (inside & (h[np.clip(at, 0, len(h) - 1)] == word)).any(1)
        return found

    def scan(self, texts: pa.Array) -> list[list]:
        """Columns: n_words, n_base, first_word, last_word, base_labels, labels, score."""
        data, at = joined(texts)
        starts, _, h = hashed_words(data, "word")
        first, n = word_ranges(starts, at), len(texts)
        doc_of = lambda i: np.searchsorted(first, i, side="right") - 1
        places: list[list[int]] = [[] for _ in range(n)]
        base: list[set[str]] = [set() for _ in range(n)]
        for phrase, label in self.phrases:
            for i in _standing(h, phrase):
                d = int(doc_of(i))
                if i + len(phrase) <= first[d + 1]:
                    places[d].append(int(i - first[d]))
                    base[d].add(label)
        labels, score = [set(x) for x in base], [1.0 if x else 0.0 for x in base]
        for d, label, share in self.accepted(h, first):
            labels[d].add(label)
            score[d] = max(score[d], share)
        line = lambda x: ",".join(sorted(x))
        return [np.diff(first).tolist(), [len(p) for p in places], [min(p) if p else None for p in places], [max(p) if p else None for p in places], [line(x) for x in base], [line(x) for x in labels], score]


def _within(first: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of some texts: which text, which word."""
    many = first[texts + 1] - first[texts]
    nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    return np.repeat(texts, many), np.repeat(first[texts], many) + nth


def _standing(h: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    m = len(h) - len(phrase) + 1
    if m <= 0:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(h[:m] == phrase[0])
    for k in range(1, len(phrase)):
        at = at[h[at + k] == phrase[k]]
    return at


COLUMNS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def templates_of(table: DataFrame) -> tuple[tuple[str, str, tuple[str, ...]], ...]:
    """Passages of a table (label, passage, keys array<string>), in the form of
    TEMPLATES. More than MOST_TEMPLATES rows, or a row without label, passage
    or key phrase, is an error."""
    rows = table.select("label", "passage", "keys").limit(MOST_TEMPLATES + 1).collect()
    if len(rows) > MOST_TEMPLATES or any(not (r.label and words(r.passage or "") and r.keys and all(words(k or "") for k in r.keys)) for r in rows):
        raise ValueError(f"up to {MOST_TEMPLATES} rows, each with a label, a passage and key phrases")
    return tuple(sorted((r.label, r.passage, tuple(r.keys)) for r in rows))


def license_scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """All columns of docs, then those of COLUMNS."""
    more = StructType.fromDDL(COLUMNS)
    docs = docs.select(*[c for c in docs.columns if c not in more.names])
    index = Index(*document_frequencies(docs, templates), templates, phrases)
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, index.scan(batch.column("text")), kinds)], names=[*batch.schema.names, *more.names])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *more.fields]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return license_scan(docs.select("doc_id", "text")).drop("text")
