"""PII by candidate gradient boosting, with SQL functions only.

Method: high-recall generators propose spans that may overlap: digit runs with
separators; names joined to a domain by ``@`` or a spelled-out at; addresses
with spaced or bracketed points or colons; opaque tokens; national ids and
account numbers.  Boosted trees score every candidate from its format (digits,
separators, checksums, case) and the words before it; thresholds calibrated on
held-back examples select those to redact.  The base spans (fixed patterns)
always stay; a selected candidate that overlaps a base span is one with it.
Secrets and national ids are none of the four kinds and go to columns of their
own.

The trees are trained in numpy on EXAMPLES synthetic lines with noise around
them, whose features come from the same SQL expressions, and become a SQL
expression themselves: on the rows of a table no Python runs, and no row leaves
its task (there is no shuffle).  Rows without a digit, ``@`` or a spelled-out
``dot`` skip the work.

Positions are code points, ends exclusive.  Base patterns use possessive
quantifiers and start only where a longest match starts, which finds the same
matches in linear time.  Defined cases: null or empty text: no spans, counts 0,
the digest of the empty string.  Columns of docs named base, spans or others
are replaced, all others stay.
"""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from normalake.llm._boosting import as_sql, boost, margin
from normalake.llm._skew import unclashed

EXAMPLES, PRECISION = 6000, 0.99
KINDS = ("email", "ip", "card", "phone")
#: Found by the method alone.
OTHERS = ("secret", "national")
_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT = r"(?:\x20?@\x20?|\x20?[\[({]\x20?at\x20?[\])}]\x20?)"
_DOT = r"(?:\.|\x20?[\[({]\x20?dot\x20?[\])}]\x20?|\x20dot\x20)"
_POINT = r"\x20?(?:\.|\[\.\]|\(\.\)|\[dot\])\x20?"
#: A candidate may be any of these; each has its own trees.
GENERATORS = {
    "number": r"(?<![0-9A-Za-z])[+(]?[0-9](?:[\x20()./-]{0,2}[0-9]){6,}+(?![0-9A-Za-z])",
    "mail": rf"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++(?:{_AT}[a-z0-9-]++(?:{_DOT}[a-z0-9-]++)++|\x20at\x20[a-z0-9-]++(?:\x20dot\x20[a-z0-9-]++)++)",
    "address": rf"(?<![0-9A-Za-z.:])(?:[0-9]{{1,3}}(?:{_POINT}[0-9]{{1,3}}){{3}}|[0-9A-Fa-f]{{1,4}}(?:::?[0-9A-Fa-f]{{1,4}}){{2,7}})(?![0-9A-Za-z:])",
    "opaque": r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/=-]*+[0-9])[A-Za-z0-9_+/=-]{16,}+",
    "identifier": r"(?<![0-9A-Za-z-])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}(?:\x20?[0-9][A-Z0-9]{3}){1,6}(?:\x20?[0-9][A-Z0-9]{0,2})?)(?![0-9A-Za-z-])",
}
TARGETS = {"card": "number", "phone": "number", "email": "mail", "ip": "address", "secret": "opaque", "national": "identifier"}
#: What a text must have for a generator to run on it.
_MAY = {
    "number": "digits",
    "mail": "(contains(t, '@') OR t RLIKE '(?i)[\\\\[({] ?at ?[\\\\])}]|\\\\bdot\\\\b')",
    "address": "digits AND t RLIKE '[0-9](?: \\\\.|\\\\. |[(\\\\[])|[0-9A-Fa-f]:'",
    "opaque": "digits AND t RLIKE '[A-Za-z0-9_+/=-]{16}'",
    "identifier": "digits AND t RLIKE '[0-9]-[0-9]{2}-[0-9]|[A-Z]{2}[0-9]{2}'",
}
_BYTE = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])){3}$"
BEFORE = 24


def _literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(name: str, value: str, body: str) -> str:
    """body with name bound to value, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _luhn(digits: str) -> str:
    n = f"length({digits})"
    d = f"CAST(substring({digits}, {n} - i, 1) AS INT)"
    return f"aggregate(transform(sequence(0, {n} - 1), i -> if(i % 2 = 1, if({d} > 4, 2 * {d} - 9, 2 * {d}), {d})), 0, (a, b) -> a + b) % 10 = 0"


def _passes(kind: str) -> str:
    digits = "regexp_replace(m.s, '[^0-9]', '')"
    if kind == "ip":
        return f"m.s RLIKE {_literal(_BYTE)}"
    if kind == "card":
        return _let("g", digits, f"length(g) BETWEEN 16 AND 19 AND {_luhn('g')}")
    if kind == "phone":
        return f"length({digits}) BETWEEN 8 AND 15"
    return "true"


def _matches(pattern: str) -> str:
    """All matches in column t: array of (a: start, b: end, s: the match).
    Prefix sums go by blocks of the square root of their number."""
    found = f"named_struct('m', regexp_extract_all(t, {_literal(pattern)}, 0), 'p', split(t, {_literal(pattern)}, -1))"
    sizes = "transform(f.m, (x, i) -> length(f.p[i]) + if(i > 0, length(f.m[greatest(i - 1, 0)]), 0))"
    total = lambda part: f"aggregate({part}, 0, (x, y) -> x + y)"
    blocks = f"transform(sequence(0, (size(l) - 1) div k), j -> {total('slice(l, j * k + 1, k)')})"
    prefix = f"transform(o, (x, j) -> {total('slice(o, 1, j)')})"
    start = f"q[i div k] + {total('slice(l, (i div k) * k + 1, i % k + 1)')}"
    spans = _let("q", prefix, f"transform(f.m, (x, i) -> {_let('z', start, chr(39).join(['named_struct(', 'a', ', z, ', 'b', ', z + length(x), ', 's', ', x)']))})")
    body = _let("l", sizes, _let("k", "CAST(ceil(sqrt(size(l))) AS INT)", _let("o", blocks, spans)))
    return _let("f", found, f"if(size(f.m) = 0, array(), {body})")


def _base(kind: str) -> str:
    may = "contains(t, '@')" if kind == "email" else "contains(t, '+')" if kind == "phone" else "digits"
    return f"if({may}, filter({_matches(PATTERNS[kind])}, m -> {_passes(kind)}), array())"


def _mod97(x: str) -> str:
    """1 if an account number has the right check digits."""
    code = f"ascii(substring({x}, (i + 4) % length({x}) + 1, 1))"
    step = f"if(c < 58, (a * 10 + c - 48) % 97, (a * 100 + c - 55) % 97)"
    return f"if(aggregate(transform(sequence(0, length({x}) - 1), i -> {code}), 0, (a, c) -> {step}) = 1, 1, 0)"


#: Features of a candidate m, with g its digits, w the text before it in lower case.
FEATURES = {
    "n_digits": "length(g)",
    "n_chars": "length(m.s)",
    "plus": "if(startswith(m.s, '+'), 1, 0)",
    "paren": "if(contains(m.s, '('), 1, 0)",
    "bracket": "if(contains(m.s, '['), 1, 0)",
    "groups": "size(split(m.s, '[^0-9]+'))",
    "dots": "length(m.s) - length(replace(m.s, '.', ''))",
    "slashes": "length(m.s) - length(replace(m.s, '/', ''))",
    "dashes": "length(m.s) - length(replace(m.s, '-', ''))",
    "luhn": f"if(length(g) > 0, if({_luhn('substring(g, 1, 19)')}, 1, 0), 0)",
    "at": "if(contains(m.s, '@'), 1, 0)",
    "dot": "if(m.s RLIKE '(?i)dot', 1, 0)",
    "letters": "length(regexp_replace(m.s, '[^A-Za-z]', ''))",
    "hex": "if(m.s RLIKE '^[0-9a-f]+$|^[0-9A-F]+$', 1, 0)",
    "mixed": "if(m.s RLIKE '[A-Z]' AND m.s RLIKE '[a-z]', 1, 0)",
    "turns": "size(split(m.s, '(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])'))",
    "colons": "length(m.s) - length(replace(m.s, ':', ''))",
    "biggest": "coalesce(array_max(transform(filter(split(m.s, '[^0-9]+'), y -> length(y) BETWEEN 1 AND 9), y -> CAST(y AS INT))), 0)",
    "mod97": "if(m.s RLIKE '^[A-Z]{2}[0-9]{2}', " + _mod97("replace(m.s, ' ', '')") + ", 0)",
    "parted": "if(m.s RLIKE '^[0-9]{3}-[0-9]{2}-[0-9]{4}$' AND NOT m.s RLIKE '^(000|666|9)|-00-|-0000$', 1, 0)",
    "set": "if(w RLIKE '[=:\"(\\']\\\\s?$', 1, 0)",
    "says_phone": "if(w RLIKE '(tel|phone|call|fax|mobile|cell|rufn|ligar|appel|llama)', 1, 0)",
    "says_card": "if(w RLIKE '(card|visa|credit|payment|amex|karte|carte|tarjeta)', 1, 0)",
    "says_mail": "if(w RLIKE '(mail|contact|write|reach|schreib|correo)', 1, 0)",
    "says_ip": "if(w RLIKE '(\\\\bip|addr|host|server|login|client|from)', 1, 0)",
    "says_secret": "if(w RLIKE '(token|secret|key|passw|pwd|auth|bearer|credential)', 1, 0)",
    "says_id": "if(w RLIKE '(ssn|social|iban|account|konto|compte|cuenta|tax|passport)', 1, 0)",
    "says_other": "if(w RLIKE '(order|invoice|isbn|serial|version|date|price|page|article|no[.]|nr[.])', 1, 0)",
    "says_hash": "if(w RLIKE '(commit|sha|md5|checksum|hash|digest|build|uuid|etag)', 1, 0)",
}
_NAMES = list(FEATURES)


def _candidates(generator: str) -> str:
    """array of (a, b, s, x: the features)."""
    x = "array(" + ", ".join(f"CAST({v} AS DOUBLE)" for v in FEATURES.values()) + ")"
    with_w = _let("w", f"lower(substring(t, greatest(m.a + 1 - {BEFORE}, 1), least(m.a, {BEFORE})))", f"named_struct('a', m.a, 'b', m.b, 's', m.s, 'x', {x})")
    return f"if({_MAY[generator]}, transform({_matches(GENERATORS[generator])}, m -> {_let('g', chr(39).join(['regexp_replace(m.s, ', '[^0-9]', ', ', '', ')']), with_w)}), array())"


def _examples(seed: int = 11) -> list[tuple[str, str]]:
    """Synthetic lines with one candidate each, and what it is ("none":
    nothing). A candidate stands among words, signs and cues of several
    languages or none, as in raw documents; the others look alike."""
    r = random.Random(seed)
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    of = lambda alphabet, n: "".join(r.choice(alphabet) for _ in range(n))
    low, high = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def checked(n: int) -> str:
        body = d(n - 1)
        for c in "0123456789":
            if sum((int(x) * 2 - 9 if int(x) > 4 else int(x) * 2) if i % 2 else int(x) for i, x in enumerate(reversed(body + c))) % 10 == 0:
                return body + c
        return body

    def account() -> str:
        land, body = of(high, 2), of("0123456789", r.choice([14, 16, 18, 20]))
        number = lambda x: int("".join(str(int(c, 36)) for c in x))
        x = land + f"{98 - number(body + land + '00') % 97:02d}" + body
        return x if r.random() < 0.5 else " ".join(x[k : k + 4] for k in range(0, len(x), 4))

    word = lambda: "".join(r.choice("abcdehilnorstuéäñ") for _ in range(r.randint(2, 8)))
    name = lambda: "".join(r.choice("abcdehilnorstu") for _ in range(r.randint(2, 8))) + r.choice(["", "", ".", "_"]) + r.choice(["", d(2), "x"])
    part = lambda: str(r.choice([r.randint(0, 255), r.randint(0, 255), r.randint(0, 9), 10, 0]))
    point = lambda: r.choice([" . ", "[.]", "(.)", " .", "[dot]"])
    token = lambda: r.choice([of("0123456789abcdef", r.choice([32, 40, 64])), of(low + high + "0123456789", r.choice([20, 24, 32, 40])), "AKIA" + of(high + "0123456789", 16), "ghp_" + of(low + high + "0123456789", 36), "sk-" + of(low + high + "0123456789", 32), of(low + high + "0123456789+/", 40) + "=="])
    out = []
    for _ in range(EXAMPLES):
        kind = r.choice(["phone", "phone", "card", "email", "ip", "secret", "national", "none", "none", "none", "none", "none"])
        if kind == "phone":
            cue = r.choice(["tel", "call", "phone:", "fax", "mobile", "Rufnummer", "appel", "cell", "llama al"])
            body = r.choice([f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"0{d(2)} {d(3)} {d(4)}", f"0{d(3)}/{d(6)}", f"+{d(2)} {d(3)} {d(7)}", f"{d(3)}.{d(3)}.{d(4)}"])
        elif kind == "card":
            cue = r.choice(["card", "visa", "credit card", "payment", "Karte", ""])
            n = checked(r.choice([15, 16]))
            body = r.choice([n, ".".join((n[:4], n[4:8], n[8:12], n[12:])), f"{n[:4]} {n[4:10]} {n[10:]}", "/".join((n[:4], n[4:8], n[8:12], n[12:]))])
        elif kind == "email":
            cue, at = r.choice(["mail", "contact", "", "write", "correo"]), r.choice(["@", " (at) ", "[at]", "(at)", " at ", " @ "])
            dot = " dot " if at == " at " else r.choice([".", " (dot) ", "[dot]", "."])
            body = f"{name()}{at}{word().encode('ascii', 'ignore').decode() or 'host'}{dot}{r.choice(['com', 'org', 'net', 'de'])}"
        elif kind == "ip":
            cue = r.choice(["ip", "host", "server", "login from", "address", "", ""])
            body = r.choice([point().join(part() for _ in range(4)), point().join(part() for _ in range(4)), ":".join(of("0123456789abcdef", r.choice([1, 3, 4])) for _ in range(8)), f"2001:db8::{of('0123456789abcdef', 4)}:{of('0123456789abcdef', 2)}", f"fe80::{of('0123456789abcdef', 4)}:{of('0123456789abcdef', 4)}:{of('0123456789abcdef', 4)}"])
        elif kind == "secret":
            cue, body = r.choice(['token = "', "token:", "secret=", "api_key = '", "password:", "Authorization: Bearer", "key", "access key"]), token()
        elif kind == "national":
            cue = r.choice(["ssn", "social security", "IBAN", "account", "Konto", "", ""])
            body = r.choice([f"{r.randint(1, 665):03d}-{r.randint(1, 99):02d}-{r.randint(1, 9999):04d}", account(), account()])
        else:
            cue, body = r.choice([
                (r.choice(["order", "invoice", "isbn", "serial", "", word()]), r.choice([d(r.randint(7, 18)), f"978-{d(1)}-{d(4)}-{d(4)}-{d(1)}", f"{d(4)} {d(4)} {d(4)} {d(4)}"])),
                (r.choice(["on", "date", ""]), r.choice([f"20{d(2)}-{d(2)}-{d(2)} {d(2)}", f"{d(2)}/{d(2)}/{d(4)}", f"{d(2)}:{d(2)}:{d(2)}", f"1{d(1)}:{d(2)}:{d(2)}:{d(2)}"])),
                (r.choice(["version", "section", "page", ""]), r.choice([f"{d(1)}.{d(3)}.{d(3)}.{d(3)}", f"{d(3)}.{d(3)}/{d(4)}", f"{d(1)} . {d(1)} . {d(1)} . {d(1)}", f"{d(3)} . {r.randint(300, 999)} . {d(2)} . {d(1)}"])),
                (r.choice(["commit", "sha256", "md5", "checksum", "build", "etag", "uuid"]), r.choice([of("0123456789abcdef", r.choice([32, 40, 64])), "-".join(of("0123456789abcdef", n) for n in (8, 4, 4, 4, 12))])),
                (r.choice(["see", "the", ""]), r.choice([f"{word()}_{word()}_{word()}_{d(2)}_{word()}", f"{of(low, 12)}/{of(low, 9)}/{d(4)}/{of(low, 6)}", f"{of(low, 14)}-{d(4)}-{of(low, 8)}", "=" * 20 + d(1), d(24)])),
                (r.choice(["meet", "look", "arrive"]), f"{word()} at {of(low, 5)} dot {of(low, 3)}" if r.random() < 0.1 else f"{r.randint(900, 999)}-{d(2)}-{d(4)}"),
                (r.choice(["part", "model", ""]), f"{of(high, 2)}{d(2)} {of(high + '0123456789', 4)} {of(high + '0123456789', 4)}"),
            ])
        sign = r.choice(["", "", "", ",", ".", ";", "###", "!!", '"', ")"])
        lead = " ".join(word() + r.choice(["", "", "", ",", "###", "&&&"]) for _ in range(3))
        line = f"{lead} {cue}{'' if cue.endswith((chr(34), chr(39), '=')) else ' '}{body}{sign} {word()}"
        out.append((line.upper() if kind in ("phone", "none") and r.random() < 0.1 else line, kind))
    return out


def train(spark: SparkSession) -> dict[str, tuple[str, float]]:
    """For each target the trees as SQL over x and the margin to pass."""
    lines = _examples()
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(lines)], "i int, t string")
    rows = rows.withColumn("digits", F.expr("t RLIKE '[0-9]'"))
    model = {}
    found = rows.select("i", *[F.expr(f"transform({_candidates(g)}, m -> m.x)").alias(g) for g in GENERATORS]).collect()  # EXAMPLES rows
    names = [f"x[{j}]" for j in range(len(_NAMES))]
    for target, generator in TARGETS.items():
        data = [(v, lines[r.i][1] == target, r.i) for r in found for v in r[generator]]
        x, y = np.array([v for v, _, _ in data], float), np.array([k for _, k, _ in data], float)
        held = np.array([i % 4 == 3 for _, _, i in data])
        trees = boost(x[~held], y[~held])
        f, own = margin(x[held], trees), y[held]
        order = np.argsort(-f, kind="stable")
        right = np.cumsum(own[order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(right >= PRECISION)
        least = float(f[order][good[-1]]) if len(good) else float("inf")
        model[target] = as_sql(trees, names), max(least, 0.0) if np.isfinite(least) else 1e9
    return model


def pii_spans(docs: DataFrame, model: dict[str, tuple[str, float]]) -> DataFrame:
    """All columns of docs, then base and spans, structs with one array of
    (start, end) for each of KINDS, and others, the same for OTHERS."""
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("base", "spans", "others")])
    own, of = unclashed(docs)
    rows = own.withColumn("t", F.coalesce(F.col(of["text"]), F.lit("")))
    rows = rows.withColumn("digits", F.expr("t RLIKE '[0-9]'"))
    ends = lambda a: f"transform({a}, m -> named_struct('start', m.a, 'end', m.b))"
    fields = [f"'{k}', {ends(_base(k))}" for k in KINDS] + [f"'c_{g}', {_candidates(g)}" for g in GENERATORS]
    apart = " AND ".join(f"NOT exists(v.{k}, y -> y.start < m.b AND m.a < y.end)" for k in KINDS)

    def chosen(kind: str) -> str:
        sql, least = model[kind]
        return ends(f"filter(v.c_{TARGETS[kind]}, m -> {_let('x', 'm.x', f'{sql} >= {least!r}D')} AND {apart})")

    base = ", ".join(f"'{k}', v.{k}" for k in KINDS)
    spans = ", ".join(f"'{k}', array_sort(concat(v.{k}, {chosen(k)}))" if k in model else f"'{k}', v.{k}" for k in KINDS)
    none = "CAST(array() AS ARRAY<STRUCT<start: INT, end: INT>>)"
    others = ", ".join(f"'{k}', {chosen(k) if k in model else none}" for k in OTHERS)
    both = _let("v", f"named_struct({', '.join(fields)})", f"named_struct('base', named_struct({base}), 'spans', named_struct({spans}), 'others', named_struct({others}))")
    empty = lambda kinds: ", ".join(f"'{k}', {none}" for k in kinds)
    nothing = f"named_struct('base', named_struct({empty(KINDS)}), 'spans', named_struct({empty(KINDS)}), 'others', named_struct({empty(OTHERS)}))"
    may = "digits OR contains(t, '@') OR t RLIKE '(?i)\\\\bdot\\\\b'"
    found = rows.select(*of.values(), F.expr(f"if({may}, {both}, {nothing})").alias("_pii"))
    return found.select(*of.values(), "_pii.base", "_pii.spans", "_pii.others").toDF(*docs.columns, "base", "spans", "others")


def _line(column: str, kinds: tuple[str, ...] = KINDS) -> str:
    each = ", ".join(f"transform({column}.{k}, m -> concat('{k}:', m.start, ':', m.end))" for k in kinds)
    return f"array_join(concat({each}), ',')"


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests; n_found counts the spans of all kinds."""
    counts = [F.expr(f"CAST(size(base.{k}) AS BIGINT)").alias(f"n_{k}") for k in KINDS]
    every = " + ".join([f"size(spans.{k})" for k in KINDS] + [f"size(others.{k})" for k in OTHERS])
    more = [F.expr(_line("others", OTHERS)).alias("other_spans"), F.expr(f"CAST({every} AS BIGINT)").alias("n_found")]
    return found.select("doc_id", *counts, F.expr(f"sha2({_line('base')}, 256)").alias("base_sha256"), F.expr(_line("spans")).alias("spans"), *more)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digest(pii_spans(docs.select("doc_id", "text"), train(spark)))
