"""Vectorised word hashing over the UTF-8 bytes of Arrow batches.

Words are maximal runs of bytes of a class (``WORD`` or ``NOT_SPACE``).  Every
byte above 0x7F is a word byte in both classes, so working on bytes gives the
same words as working on characters.  A-Z hash like a-z.

A word's hash is a polynomial over the ring of 64-bit integers with random
values for bytes, taken from prefix sums: one pass over the bytes serves all
words.  Work is cut into blocks at word ends, so memory follows the block, not
the longest text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

BLOCK = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


class Memo:
    """A function that remembers its results in its process; pickled, it goes
    without them."""

    def __init__(self, f: Callable):
        self.f, self.got = f, {}

    def __call__(self, *args):
        if args not in self.got:
            self.got[args] = self.f(*args)
        return self.got[args]

    def __reduce__(self):
        return Memo, (self.f,)


@Memo
def classes(kind: str) -> np.ndarray:
    """Which bytes belong to a word. ``word``: letters, digits, all above
    0x7F. ``nonspace``: all but space and 0x09-0x0D."""
    t = np.zeros(256, bool)
    if kind == "word":
        t[48:58] = t[65:91] = t[97:123] = t[128:] = True
    else:
        t[:] = True
        t[[9, 10, 11, 12, 13, 32]] = False
    return t


@Memo
def hash_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(20240229))
    values = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
    values[65:91] = values[97:123]
    n = BLOCK + 1
    with np.errstate(over="ignore"):
        power, back = np.full(n, _BASE, _U), np.full(n, pow(_BASE, -1, 1 << 64), _U)
        power[0] = back[0] = 1
        np.multiply.accumulate(power, out=power)
        np.multiply.accumulate(back, out=back)
    return values, power, back


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (a bijection)."""
    h = h ^ (h >> _U(32))
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    return h


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes with one line feed after each text, and where each text
    starts (one more entry for the end). Null counts as empty."""
    parts = [b"" if x is None else x for x in texts.cast(pa.large_binary()).to_pylist()]
    at = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(x) + 1 for x in parts], out=at[1:])
    parts.append(b"")
    return np.frombuffer(b"\n".join(parts), np.uint8), at


def _cut(member: np.ndarray) -> int:
    """How much of a full block to take: up to its last byte outside words, or
    all of it if it is one long word (its pieces are joined by the caller)."""
    for back in (4096, len(member)):
        gap = np.flatnonzero(~member[-back:])
        if len(gap):
            return len(member) - min(back, len(member)) + int(gap[-1]) + 1
    return len(member)


def hashed_words(data: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end (exclusive) in bytes and the hash of each word."""
    values, power, back = hash_tables()
    table, n = classes(kind), len(data)
    starts, ends, hashes = [], [], []
    lo, carry = 0, None  # carry: an unfinished word as (start, hash, length)
    while lo < n:
        member = table[data[lo : min(lo + BLOCK, n)]]
        hi = lo + _cut(member) if lo + BLOCK < n else n
        member = member[: hi - lo]
        edge = np.flatnonzero(np.diff(np.concatenate(([0], member.view(np.int8), [0]))))
        s, e = edge[::2], edge[1::2]
        if len(s):
            sums = np.zeros(hi - lo + 1, _U)
            np.cumsum(values[data[lo:hi]] * power[: hi - lo], out=sums[1:])
            h = (sums[e] - sums[s]) * back[s]
            s, e = s + lo, e + lo
            if carry is not None and s[0] == lo:
                h[:1] = carry[1] + h[:1] * _U(pow(_BASE, carry[2], 1 << 64))
                s[0] = carry[0]
                carry = None
            if carry is not None:
                starts.append(np.array([carry[0]])), ends.append(np.array([lo])), hashes.append(np.array([carry[1]], _U))
                carry = None
            if hi < n and e[-1] == hi:
                carry = (int(s[-1]), h[-1], int(e[-1] - s[-1]))
                s, e, h = s[:-1], e[:-1], h[:-1]
            starts.append(s), ends.append(e), hashes.append(h)
        elif carry is not None:
            starts.append(np.array([carry[0]])), ends.append(np.array([lo])), hashes.append(np.array([carry[1]], _U))
            carry = None
        lo = hi
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U)
    return np.concatenate(starts), np.concatenate(ends), mix(np.concatenate(hashes))


def hash_of(words: list[str], kind: str = "word") -> np.ndarray:
    """The hashes that the given words have in texts, in their order."""
    data, at = joined(pa.array(words, pa.string()))
    s, _, h = hashed_words(data, kind)
    if len(h) != len(words):
        raise ValueError(f"each entry must be one word: {words}")
    return h


def word_ranges(starts: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each text the index of its first word; one more entry for the end."""
    return np.searchsorted(starts, at)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive words, by the first one's index."""
    m = max(0, len(h) - n + 1)
    out = np.zeros(m, _U)
    for j in range(n):
        out += h[j : j + m] * _U(pow(0xC2B2AE3D27D4EB4F, j + 1, 1 << 64))
    return mix(out)


def small_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text; a longer
    text is alone in its batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.nan_to_num(pa.compute.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(float)) + 1
        total, lo = np.cumsum(sizes), 0
        while lo < len(sizes):
            base = total[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(total, base + limit, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi
