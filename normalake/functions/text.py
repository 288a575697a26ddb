"""Text cleaning, folding and hashing as column expressions."""

from __future__ import annotations

import functools
import sys
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_EDGES = r"^[\s\x0B\p{Z}]+|[\s\x0B\p{Z}]+$"


def strip(c: Column) -> Column:
    """Without white space of any script at either end (trim takes spaces only)."""
    return F.regexp_replace(c, _EDGES, "")


def clean_ocr(c: Column) -> Column:
    """Without control characters but tab and line ends; null becomes empty."""
    return strip(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", ""))


@functools.lru_cache(None)
def _bases() -> tuple[str, str]:
    """Characters that decompose to one base and marks, and these bases; from
    the Unicode rule, Hangul aside."""
    old, new = [], []
    for n in range(0xC0, sys.maxunicode + 1):
        if 0xAC00 <= n <= 0xD7A3 or 0xD800 <= n <= 0xDFFF:
            continue
        parts = [x for x in unicodedata.normalize("NFD", chr(n)) if unicodedata.category(x) != "Mn"]
        if len(parts) == 1 and parts[0] != chr(n) and ord(parts[0]) < 0x10000 and n < 0x10000:
            old.append(chr(n))
            new.append(parts[0])
    return "".join(old), "".join(new)


def strip_accents(c: Column) -> Column:
    """Canonical decomposition without non-spacing marks, as built-ins: a
    character map for composed letters, then the loose marks go."""
    old, new = _bases()
    return F.regexp_replace(F.translate(c, old, new), r"\p{Mn}+", "")


def _normal(form: str):
    @F.pandas_udf("string")
    def normal(s: pd.Series) -> pd.Series:
        return pd.Series([unicodedata.normalize(form, x) if isinstance(x, str) else None for x in s], dtype=object)

    return normal


_SCRIPTS = 0x2100  # Latin, Greek, Cyrillic and general punctuation lie below


@functools.lru_cache(None)
def _unsettled() -> str:
    """A class of the characters that composition may change, or that join one
    before: all beyond _SCRIPTS, and below it by the Unicode rule."""
    odd = [n for n in range(_SCRIPTS) if unicodedata.normalize("NFC", chr(n)) != chr(n) or unicodedata.category(chr(n))[0] == "M" or 0x1100 <= n < 0x1200]
    return _class(odd)


@functools.lru_cache(None)
def _searchable() -> tuple[str, str, str]:
    """For normalize_search: characters whose compatibility form is one other
    character and marks, these, and a class of those that need more."""
    old, new, odd = [], [], []
    for n in range(0xA0, _SCRIPTS):
        form = "".join(x for x in unicodedata.normalize("NFKD", chr(n)) if unicodedata.category(x)[0] != "M")
        if len(form) == 1 and form != chr(n):
            old.append(chr(n)), new.append(form)
        elif len(form) > 1 and any(x.isalnum() or x.isspace() for x in form):
            odd.append(n)
    return "".join(old), "".join(new), _class(odd)


def _class(odd: list[int]) -> str:
    ends = [(n, m) for n, m in zip([n for n in odd if n - 1 not in odd], [n for n in odd if n + 1 not in odd])]
    return "[" + "".join(f"\\x{{{n:X}}}-\\x{{{m:X}}}" for n, m in ends) + rf"\x{{{_SCRIPTS:X}}}-\x{{10FFFF}}]"


def nfc(c: Column) -> Column:
    """Composed form. Only rows with a character that it may change go to
    Python; the others are what they are."""
    odd = c.rlike(_unsettled())
    return F.when(odd, _normal("NFC")(F.when(odd, c))).otherwise(c)


def nfkd(c: Column) -> Column:
    return _normal("NFKD")(c)


def normalize_search(c: Column) -> Column:
    """For the staging table: NFKD without marks, lower case, one space for
    white space, then all but a-z, 0-9 and white space goes. A character map
    serves most rows; those with one that needs more go to Python."""
    old, new, odd_class = _searchable()
    text = F.coalesce(c, F.lit(""))
    odd = text.rlike(odd_class)
    plain = F.when(odd, nfkd(F.when(odd, text))).otherwise(F.translate(text, old, new))
    t = F.lower(F.regexp_replace(plain, r"\p{M}+", ""))
    return strip(F.regexp_replace(F.regexp_replace(t, r"(?U)\s+", " "), r"[^a-z0-9\s]", ""))


def normalize_text(c: Column) -> Column:
    """For the published table: NFC with white space collapsed; accents and
    case stay."""
    return strip(F.regexp_replace(nfc(c), r"(?U)\s+", " "))


def hash_text(c: Column) -> Column:
    """sha256: and the digest; null for null and empty."""
    return F.when(c != "", F.concat(F.lit("sha256:"), F.sha2(c, 256)))


def fold(c: Column) -> Column:
    return F.lower(strip_accents(c))


def contains_folded(c: Column, term: str) -> Column:
    """Accent- and case-insensitive containment; nothing is a wildcard."""
    plain = "".join(x for x in unicodedata.normalize("NFD", term) if unicodedata.category(x) != "Mn").lower()
    return F.instr(fold(c), plain) > 0 if plain else F.lit(True)


def like_pattern(term: str) -> str:
    """A LIKE pattern in which the term's % and _ are wildcards and a
    backslash is itself."""
    return "%" + term.replace("\\", "\\\\") + "%"


def context(text: Column, start: Column, end: Column, width: int = 30) -> Column:
    """A keyword with its surroundings: line ends become spaces, cut ends an
    ellipsis. Positions from 0, end exclusive."""
    lo = F.greatest(start - width, F.lit(0))
    hi = F.least(end + width, F.length(text))
    body = F.regexp_replace(F.substring(text, lo + 1, hi - lo), "\n", " ")
    return F.concat(F.when(lo > 0, F.lit("…")).otherwise(F.lit("")), body, F.when(hi < F.length(text), F.lit("…")).otherwise(F.lit("")))


def distinct_lines(c: Column) -> Column:
    """Trimmed lines, first occurrence first, blanks dropped."""
    return F.array_distinct(F.filter(F.transform(F.split(c, r"\r?\n", -1), strip), lambda x: x != ""))
