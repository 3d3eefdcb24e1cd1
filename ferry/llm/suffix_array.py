"""Suffix arrays by grouping (two phases, no recursion), for many strings side by side.

Phase 1 groups the suffixes of each string by their longest Lyndon prefix. Groups are worked off from
the greatest to the least. For every suffix of the current group the previous smaller suffix is found
by following the pointers of suffixes already done; it takes the group's Lyndon word into its own prefix,
once for each suffix that points at it, and moves to a new group behind its old one, further back the
more often. Groups stand together in the array throughout, so the current one is a slice and a step
costs as much as it moves. Phase 2 emits the order: from the least suffix on, the suffix before each
emitted one, and then its chain of previous smaller suffixes, go to the next free place of their groups.

A step of phase 1 does the same thing for all strings, so its fixed cost is shared by them.
"""

from __future__ import annotations

from array import array
from collections.abc import Sequence

import numpy as np

LONG = 1 << 16              # places from which a string's order is emitted in arrays


def _groups(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phase 1: the first place of each suffix's group, and its previous smaller suffix (-1: none)."""
    n = len(text)
    row = np.repeat(np.arange(len(starts)), ends - starts)
    key = (row << 16) | text.astype(np.int64)
    sa = np.argsort(key).astype(np.int32)
    place = np.empty(n, dtype=np.int32)
    place[sa] = np.arange(n, dtype=np.int32)
    first = np.ones(n, dtype=bool)
    first[1:] = key[sa[1:]] != key[sa[:-1]]
    heads = np.flatnonzero(first).astype(np.int32)
    size = np.zeros(n, dtype=np.int32)
    size[heads] = np.diff(np.append(heads, n))
    # a suffix of the string before has a lesser label than any here, and so has the place before the first string
    label = np.empty(n + 1, dtype=np.int32)
    label[sa] = np.repeat(heads, size[heads])
    label[n] = -1
    prev = np.arange(-1, n - 1, dtype=np.int32)
    moved = np.zeros(n, dtype=bool)
    begin, limit = starts.astype(np.int32), ends.astype(np.int32)
    while True:
        now = label[sa[limit - 1]]
        going = now > begin                 # the first group of a string is its final 0
        if not going.all():
            begin, limit, now = begin[going], limit[going], now[going]
        if not len(begin):
            break
        count = limit - now
        if count.max() == 1:
            i, here, low = sa[now], now, begin
        else:
            cut = np.cumsum(count)
            i = sa[np.arange(cut[-1], dtype=np.int32) + np.repeat(now - (cut - count), count)]
            here, low = np.repeat(now, count), np.repeat(begin, count)
        limit = now
        p = i - 1
        todo = np.flatnonzero(label[p] >= here)
        at, bound = p[todo], here[todo]
        while len(todo):
            at = prev[at]
            p[todo] = at
            on = np.flatnonzero(label[at] >= bound)
            todo, at, bound = todo[on], at[on], bound[on]
        some = p >= low
        prev[i] = np.where(some, p, -1)
        p = p[some]
        if not len(p):
            continue
        p.sort()
        new = np.ones(len(p), dtype=bool)
        new[1:] = p[1:] != p[:-1]
        at = np.flatnonzero(new)
        cell = p[at]
        times = np.diff(np.append(at, len(p)))
        old = label[cell]
        by = np.argsort((old.astype(np.int64) << 32) | times)       # in any order where both agree
        cell, times, old = cell[by], times[by], old[by]
        new_home = np.ones(len(cell), dtype=bool)
        new_home[1:] = old[1:] != old[:-1]
        new_set = new_home.copy()
        new_set[1:] |= times[1:] != times[:-1]
        home = np.flatnonzero(new_home)
        many = np.diff(np.append(home, len(cell)))
        tail = (old[home] + size[old[home]] - many).astype(np.int32)
        nth = np.arange(len(cell), dtype=np.int32)
        target = nth + np.repeat(tail - home.astype(np.int32), many)
        was = place[cell]
        # suffixes that stay give up their places in the tail for those left by the movers
        moved[cell] = True
        there = sa[target]
        staying = there[~moved[there]]
        holes = was[was < np.repeat(tail, many)]
        moved[cell] = False
        sa[holes] = staying
        place[staying] = holes
        sa[target] = cell
        place[cell] = target
        sets = np.flatnonzero(new_set)
        set_size = np.diff(np.append(sets, len(cell)))
        size[old[home]] -= many.astype(np.int32)
        size[target[sets]] = set_size
        label[cell] = np.repeat(target[sets], set_size)
    return label[:n], prev


def suffix_arrays(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Suffix arrays of the strings ``text[starts[k]:starts[k + 1]]`` (small ints), one after the other, as
    places in ``text``. Each string ends in the only 0 it has."""
    ends = np.append(starts[1:], len(text))
    label, prev = _groups(text, starts, ends)
    out = np.empty(len(text), dtype=np.int32)
    for low, high in zip(starts.tolist(), ends.tolist()):
        out[low:high] = _emitted(label[low:high] - low, prev[low:high] - low)
        out[low:high] += low
    return out


def _emitted(label: np.ndarray, prev: np.ndarray) -> Sequence[int]:
    """Phase 2 for one string. Each place depends on the one before, so this is a plain loop: with few strings side by
    side an array call a place costs more than the place itself. A long string is held in arrays of four bytes a place,
    where lists would take some 150."""
    n = len(label)
    held = np.ndarray.tolist if n < LONG else lambda x: array("i", x.astype(np.int32).tobytes())
    label, prev, out, free = (held(x) for x in (label, prev, np.full(n, n - 1), np.arange(n)))
    open_ = bytearray(b"\1") * n
    open_[-1] = 0                   # the final 0 is the least suffix
    free[0] = 1
    for i in range(n):
        t = out[i] - 1
        while t >= 0 and open_[t]:
            open_[t] = 0
            group = label[t]
            where = free[group]
            free[group] = where + 1
            out[where] = t
            t = prev[t]
    return out
