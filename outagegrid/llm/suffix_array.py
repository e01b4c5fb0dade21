"""Suffix arrays by induced sorting, on arrays: buckets of one symbol are induced at a time."""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)


def _smaller_types(t: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one. The last symbol must be the only smallest one."""
    n = len(t)
    ends = np.flatnonzero(np.r_[t[1:] != t[:-1], True])  # last place of every run
    rises = np.zeros(len(ends), bool)
    rises[:-1] = t[ends[:-1]] < t[ends[:-1] + 1]
    rises[-1] = True
    return np.repeat(rises, np.diff(np.r_[-1, ends])) if n else np.zeros(0, bool)


def _push(sa: np.ndarray, t: np.ndarray, places: np.ndarray, edge: np.ndarray, forward: bool) -> None:
    """Put suffixes at their buckets' free edge, in the given order."""
    symbols = t[places]
    order = np.argsort(symbols, kind="stable")
    sorted_symbols, places = symbols[order], places[order]
    count = np.bincount(sorted_symbols, minlength=len(edge))
    nth = np.arange(len(places)) - np.repeat(np.cumsum(count) - count, count)
    if forward:
        sa[edge[sorted_symbols] + nth] = places
        edge += count
    else:
        sa[edge[sorted_symbols] - 1 - nth] = places
        edge -= count


def _induce(t: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray, size: int) -> np.ndarray:
    """Suffix order from the order of the leftmost-smaller suffixes: larger ones are induced left to right, smaller ones
    right to left, one bucket of equal first symbols after the other."""
    count = np.bincount(t, minlength=size)
    end = np.cumsum(count)
    start = end - count
    sa = np.full(len(t), -1, dtype=np.int64)
    tail = end.copy()
    _push(sa, t, leftmost[::-1], tail, forward=False)
    head, present = start.copy(), np.flatnonzero(count)
    for b in present:
        low = start[b]
        while low < head[b]:
            high = head[b]
            before = sa[low:high] - 1
            before = before[before >= 0]
            _push(sa, t, before[~smaller[before]], head, forward=True)
            low = high
        before = sa[tail[b] : end[b]] - 1
        before = before[before >= 0]
        _push(sa, t, before[~smaller[before]], head, forward=True)
    larger_end, tail = head, end.copy()
    for b in present[::-1]:
        high = end[b]
        while high > tail[b]:
            low = tail[b]
            before = sa[low:high][::-1] - 1
            before = before[before >= 0]
            _push(sa, t, before[smaller[before]], tail, forward=False)
            high = low
        before = sa[start[b] : larger_end[b]][::-1] - 1
        before = before[before >= 0]
        _push(sa, t, before[smaller[before]], tail, forward=False)
        if b == t[-1]:  # the sentinel's own suffix is induced by nothing
            sa[start[b]] = len(t) - 1
            tail[b] = start[b]
    return sa


def _ranks(names: np.ndarray) -> np.ndarray:
    """Ranks of the suffixes of a string of names, by joining ranks of neighbours until all differ. A rank counts the smaller
    suffixes, so those that differ from all others already keep theirs and are sorted no more."""
    n, width = len(names), 1
    order = np.argsort(names, kind="stable")
    new = np.flatnonzero(np.r_[True, names[order][1:] != names[order][:-1]])
    size = np.diff(np.r_[new, n])
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.repeat(new, size)
    open_ = order[np.repeat(size > 1, size)]
    while len(open_):
        behind = open_ + width
        after = np.where(behind < n, rank[np.minimum(behind, n - 1)] + 1, 0)
        key = rank[open_] * (n + 1) + after
        by = np.argsort(key)
        open_, key = open_[by], key[by]
        shared = rank[open_]
        group = np.flatnonzero(np.r_[True, shared[1:] != shared[:-1]])
        place = shared + np.arange(len(open_)) - np.repeat(group, np.diff(np.r_[group, len(open_)]))
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[new, len(open_)])
        rank[open_] = np.repeat(place[new], size)
        open_ = open_[np.repeat(size > 1, size)]
        width *= 2
    return rank


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``t``: integers, the last one smaller than all others."""
    size = int(t.max()) + 1
    smaller = _smaller_types(t)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(leftmost) < 2:
        return _induce(t, smaller, leftmost, size)
    # First pass: leftmost-smaller substrings in order.
    order = _induce(t, smaller, leftmost, size)
    is_leftmost = np.zeros(len(t), bool)
    is_leftmost[leftmost] = True
    order = order[is_leftmost[order]]
    # Equal substrings get one name; a substring ends with the next leftmost-smaller place.
    stop = np.r_[leftmost[1:] + 1, len(t)]
    length = np.zeros(len(t), np.int64)
    length[leftmost] = stop - leftmost
    power = np.cumprod(np.r_[np.uint64(1), np.full(len(t), BASE)])
    sums = np.r_[np.uint64(0), np.cumsum((t.astype(np.uint64) + np.uint64(1)) * power[:-1])]
    spread = (sums[order + length[order]] - sums[order]) * power[len(t) - order]
    new = np.r_[True, (spread[1:] != spread[:-1]) | (length[order[1:]] != length[order[:-1]])]
    name = np.zeros(len(t), np.int64)
    name[order] = np.cumsum(new) - 1
    names = name[leftmost]
    rank = names if new.all() else _ranks(names)
    return _induce(t, smaller, leftmost[np.argsort(rank, kind="stable")], size)


def permuted_common_prefixes(t: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For every place, how many symbols its suffix shares with its predecessor in ``sa``. Only irreducible values are
    compared, several symbols at once; the others are one less than their left neighbour's."""
    n = len(t)
    previous = np.full(n, -1, dtype=np.int64)
    previous[sa[1:]] = sa[:-1]
    at = np.arange(n)
    has = previous >= 0
    reducible = has & (at > 0) & (previous > 0)
    reducible[reducible] = t[at[reducible] - 1] == t[previous[reducible] - 1]
    out = np.zeros(n, dtype=np.int64)
    open_ = np.flatnonzero(has & ~reducible)
    # As many symbols in a number as it holds. Two suffixes differ where the last symbol, the only smallest, ends one.
    bits = max(1, int(t.max()).bit_length())
    per = max(1, 63 // bits)
    packed = np.zeros(n, dtype=np.uint64)
    for k in range(min(per, n)):
        packed[: n - k] |= t[k:].astype(np.uint64) << np.uint64(bits * k)
    other, done = previous[open_], 0
    while len(open_):
        apart = packed[open_ + done] ^ packed[other + done]
        same = apart == 0
        differ = apart[~same]
        out[open_[~same]] = done + np.bitwise_count((differ & -differ) - np.uint64(1)).astype(np.int64) // bits
        open_, other = open_[same], other[same]
        done += per
    last = np.maximum.accumulate(np.where(reducible, -1, at))
    return np.where(reducible, np.maximum(out[last] - (at - last), 0), out)
