"""URL filters: a weighted vocabulary found by Aho-Corasick, under host rules.

Method: one automaton finds strict and soft terms in the lower-cased url; a hit
counts only between characters other than letters and digits (or the ends).
Terms are given as words or come from a table.  Distinct hits add up, a strict term with weight SEVERAL, a soft one with 1; from SEVERAL
the url is blocked, so one strict or several distinct soft terms suffice.

Rules (verdict, host, path) come first: a rule fits its host and all
subdomains if the url's path starts with the rule's; the longest wins, then the
smaller text.  They are looked up by host suffix, so their number does not
matter.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower;
path: from there up to ``?``, ``#`` or the end.  Defined cases: null urls and
urls without ``://`` have an empty host and path, and a null url has no hits
(allow).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEVERAL, MOST_TERMS = 2, 500_000
STRICT = ("casino", "porn", "porno", "xxx", "sexcam", "escorts", "hentai", "viagra", "adult")
SOFT = ("ads", "bet", "bets", "betting", "cheap", "click", "deal", "farm", "free", "jackpot", "loan", "pills", "poker", "slots", "spam", "track", "tracker", "win", "winner", "warez")
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))
_LOWER = {a: a + 32 for a in range(65, 91)}
_PARTS = re.compile(r".*?://([^/?#]*)([^?#]*)", re.S)


def parts(url: str | None) -> tuple[str, str]:
    m = _PARTS.match(url or "")
    return (m[1].translate(_LOWER), m[2]) if m else ("", "")


def automaton(strict: tuple[str, ...] = STRICT, soft: tuple[str, ...] = SOFT):
    import ahocorasick

    found = ahocorasick.Automaton()
    for term in soft:
        found.add_word(term, (term, 1))
    for term in strict:
        found.add_word(term, (term, SEVERAL))
    found.make_automaton()
    return found


def _alone(url: str, start: int, end: int) -> bool:
    return not (start and url[start - 1].isalnum()) and not (end < len(url) and url[end].isalnum())


def terms(url: str | None, found) -> dict[str, int]:
    """The distinct terms of a url and their weights."""
    low = (url or "").translate(_LOWER)
    return {term: weight for last, (term, weight) in found.iter(low) if _alone(low, last - len(term) + 1, last + 1)}


def vocabulary(table: DataFrame) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """table (term, weight) -> strict and soft terms: a weight of SEVERAL or more
    is strict. Terms are lower-cased, empty and null ones left out, and of a
    term's weights the largest counts. Up to MOST_TERMS go to the tasks; more
    are an error."""
    best = table.where("term IS NOT NULL AND term <> '' AND weight > 0").groupBy(F.lower("term").alias("term")).agg(F.max("weight").alias("weight"))
    found = best.limit(MOST_TERMS + 1).collect()
    if len(found) > MOST_TERMS:
        raise ValueError(f"more than {MOST_TERMS} terms")
    strict = sorted(r.term for r in found if r.weight >= SEVERAL)
    return tuple(strict), tuple(sorted(r.term for r in found if r.weight < SEVERAL))


def by_host(rules) -> dict[str, list[tuple[str, str, str]]]:
    """Each host's rules (text, path, verdict), longest first."""
    out: dict[str, list] = {}
    for verdict, host, path in rules:
        out.setdefault(host, []).append((host + path, path, verdict))
    return {host: sorted(x, key=lambda r: (-len(r[0]), r[0])) for host, x in out.items()}


def rule_of(host: str, path: str, rules: dict) -> tuple[str, str] | None:
    """Text and verdict of the rule that wins."""
    labels, best = host.split("."), None
    for i in range(len(labels)):
        for text, start, verdict in rules.get(".".join(labels[i:]), ()):
            if path.startswith(start):
                if best is None or (-len(text), text) < (-len(best[0]), best[0]):
                    best = text, verdict
                break
    return best


def judge(pages: DataFrame, rules=RULES, strict: tuple[str, ...] = STRICT, soft: tuple[str, ...] = SOFT) -> DataFrame:
    """pages (page_id, url) -> page_id, host, path, rule, verdict, score, hits."""
    known = by_host(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(strict, soft)
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for url in batch.column("url").to_pylist():
                host, path = parts(url)
                hits = terms(url, found)
                rule, score = rule_of(host, path, known), sum(hits.values())
                row = host, path, rule and rule[0], rule[1] if rule else "block" if score >= SEVERAL else "allow", score, ",".join(sorted(hits))
                for column, value in zip(out, row):
                    column.append(value)
            kinds = [pa.string()] * 4 + [pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), *map(pa.array, out, kinds)], names=["page_id", "host", "path", "rule", "verdict", "score", "hits"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url").mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string, score long, hits string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def _sql() -> str:
    low = "translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    hit = lambda t: f"regexp_matches(low, '(^|[^\\p{{L}}\\p{{N}}]){t}($|[^\\p{{L}}\\p{{N}}])')"
    every = sorted({*STRICT, *SOFT})
    score = " + ".join(f"CASE WHEN {hit(t)} THEN {SEVERAL if t in STRICT else 1} ELSE 0 END" for t in every)
    hits = ", ".join(f"CASE WHEN {hit(t)} THEN '{t}' END" for t in every)
    values = ", ".join(f"('{h}{p}', '{h}', '{p}', '{v}')" for v, h, p in RULES)
    return f"""
WITH p AS (
  SELECT page_id, {low} AS low,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
r(rule, h, start, verdict) AS (VALUES {values}),
s AS (SELECT *, CAST({score} AS BIGINT) AS score, concat_ws(',', {hits}) AS hits,
  (SELECT max_by(struct_pack(rule := r.rule, verdict := r.verdict), length(r.rule)) FROM r
    WHERE (p.host = r.h OR ends_with(p.host, '.' || r.h)) AND starts_with(p.path, r.start)) AS won
  FROM p)
SELECT page_id, host, path, won.rule AS rule,
       coalesce(won.verdict, CASE WHEN score >= {SEVERAL} THEN 'block' ELSE 'allow' END) AS verdict, score, hits FROM s
"""


SQL = _sql()
