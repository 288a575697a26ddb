"""Suffix arrays of many strings at once by linear grouping construction.

Suffixes are grouped by their longest Lyndon prefix.  Groups are processed in
descending order: the previous-smaller pointers of a group's suffixes lead to
suffixes of smaller groups, and those that l pointers lead to leave their group
for one just above it, the higher the larger l.  When all groups are done, a
pass in ascending order emits each group's suffixes through the same pointers,
without sorting or renaming again.  Each suffix is in one group at a time and
processed once.

All strings advance together: a step takes the highest open group of every
string, so numpy works on many suffixes at a time.
"""

from __future__ import annotations

import numpy as np


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and which range each is of."""
    size = hi - lo
    of = np.repeat(np.arange(len(lo)), size)
    return np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + lo[of], of


def _grouped(text: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each suffix's group, named by its first place, and its pointer."""
    n = len(text)
    of = np.repeat(np.arange(len(lo)), hi - lo)
    kinds = int(text.max()) + 1
    sa = np.argsort(of * kinds + text, kind="stable")
    at = np.empty(n, np.int64)
    at[sa] = np.arange(n)
    key = (of * kinds + text)[sa]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    group = np.empty(n, np.int64)
    group[sa] = np.repeat(first, np.diff(first, append=n))
    end_of = np.zeros(n, np.int64)
    end_of[first] = np.append(first[1:], n)
    prev = np.arange(n) - 1
    prev[lo] = -1
    inside = np.zeros(n, bool)
    top, base = hi.copy(), lo + 1  # the sentinel's group is the last
    while True:
        more = top > base
        if not more.any():
            return group, prev
        top, base = top[more], base[more]
        g = group[sa[top - 1]]
        places, which = _ranges(g, top)
        top = g
        i = sa[places]
        own = g[which]
        p = prev[i]
        open_ = np.flatnonzero(p >= 0)
        while len(open_ := open_[group[p[open_]] >= own[open_]]):
            prev[i[open_]] = p[open_] = prev[p[open_]]
            open_ = open_[p[open_] >= 0]
        p = p[p >= 0]
        if not len(p):
            continue
        p, many = np.unique(p, return_counts=True)
        h = group[p]
        order = np.lexsort((many, h))
        p, many, h = p[order], many[order], h[order]
        new = np.flatnonzero(np.diff(h, prepend=-1))
        size = np.diff(new, append=len(p))
        end = end_of[h[new]]
        target, part = _ranges(end - size, end)
        # the highest places of each group are for those that leave it
        there = sa[target]
        inside[p] = True
        others = there[~inside[there]]
        inside[p] = False
        old = at[p]
        left = old[old < (end - size)[part]]
        sa[left], at[others] = others, left
        sa[target], at[p] = p, target
        end_of[h[new]] = end - size
        cut = np.flatnonzero((np.diff(h, prepend=-1) != 0) | (np.diff(many, prepend=-1) != 0))
        many_in = np.diff(cut, append=len(p))
        starts = target[cut]
        group[p] = np.repeat(starts, many_in)
        end_of[starts] = starts + many_in


def suffix_arrays(text: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """text: strings one after the other, lo: where each begins; the last
    symbol of each string is smaller than all others of it -> the suffixes of
    each string in order, in the string's own places."""
    n = len(text)
    hi = np.append(lo[1:], n)
    text = text.astype(np.int64)
    group, prev = _grouped(text, lo, hi)
    sa = np.empty(n, np.int64)
    free = np.arange(n)
    done = np.zeros(n, bool)
    sa[lo] = hi - 1
    done[hi - 1] = True
    i, j, low, end = lo.copy(), hi - 2, lo, hi
    while len(i):
        ok = j >= low
        ok[ok] = ~done[j[ok]]
        on = j[ok]
        place = free[group[on]]
        sa[place] = on
        free[group[on]] = place + 1
        done[on] = True
        j = np.where(ok, prev[j], j)
        ended = ~ok
        i = i + ended
        more = i < end
        if not more.all():
            i, j, low, end, ended = i[more], j[more], low[more], end[more], ended[more]
        j[ended] = sa[i[ended]] - 1
    return sa
