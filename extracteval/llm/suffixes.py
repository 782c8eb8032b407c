"""Suffix arrays by induced sorting, and common prefixes in text order.

``suffix_array`` classifies suffixes as smaller (S) or larger (L) than their successor, sorts the
leftmost-smaller (LMS) substrings by one induction, names them, sorts the string of names recursively
and induces the order of all suffixes from that of the LMS suffixes.  An induction over few symbols runs
bucket by bucket with array operations, one over many symbols (the recursion's names) item by item;
both are linear.

``permuted_prefixes`` gives each position's common prefix with its predecessor in the suffix array, in
text order: a position's value is its left neighbour's less one unless the letters before the two
suffixes differ, so letters are compared only where they do.
"""

from __future__ import annotations

import numpy as np

PER_BUCKET = 512  # items a bucket from which array operations pay


def _smaller(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; the last (the sentinel) is."""
    n = len(s)
    out = np.ones(n, dtype=bool)
    if n > 1:
        # the next place where the symbol changes; the sentinel makes the last change
        change = np.where(s[:-1] != s[1:], np.arange(n - 1), n)
        first = np.minimum.accumulate(change[::-1])[::-1]
        out[:-1] = s[first] < s[first + 1]
    return out


def _by_symbol(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order by symbol, and each item's rank among those of its symbol."""
    order = np.argsort(symbols, kind="stable")
    ranked = symbols[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    return order, np.arange(len(ranked)) - np.repeat(first, np.diff(np.append(first, len(ranked))))


def _induce_buckets(s: np.ndarray, smaller: np.ndarray, counts: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    n, sigma = len(s), len(counts)
    end = np.cumsum(counts)
    begin = end - counts
    sa = np.full(n, -1, dtype=np.int64)
    by_symbol = np.searchsorted(s[seeds], np.arange(sigma + 1)).tolist()
    head, filled = begin.copy(), begin.tolist()

    def place(batch: np.ndarray, kind: bool, at: np.ndarray, step: int) -> None:
        before = batch - 1
        before = before[before >= 0]
        before = before[smaller[before] == kind]
        if len(before):
            order, rank = _by_symbol(s[before])
            before = before[order]
            symbols = s[before]
            sa[at[symbols] + step * rank] = before
            at += step * np.bincount(symbols, minlength=sigma)

    for c in range(sigma):
        done = filled[c]
        while done < (now := int(head[c])):
            place(sa[done:now], False, head, 1)
            done = now
        if by_symbol[c] < by_symbol[c + 1]:
            place(seeds[by_symbol[c] : by_symbol[c + 1]], False, head, 1)
    tail = end - 1
    sa[0] = n - 1
    tail[0] -= 1
    for c in range(sigma - 1, -1, -1):
        done = int(end[c]) - 1 if c else 0
        while done > (now := int(tail[c])):
            place(sa[now + 1 : done + 1][::-1], True, tail, -1)
            done = now
        if head[c] > begin[c]:
            place(sa[begin[c] : head[c]][::-1], True, tail, -1)
    return sa


def _induce_items(s: np.ndarray, smaller: np.ndarray, counts: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    n, end = len(s), np.cumsum(counts)
    # the symbol before each position if that suffix is of the wanted kind, else -1; n stands for no position
    before = np.full(n + 1, -1, dtype=np.int64)
    before[1:n] = np.where(smaller[:-1], -1, s[:-1])
    larger = before.tolist()
    before[1:n] = np.where(smaller[:-1], s[:-1], -1)
    lesser = before.tolist()
    start = np.full(n, n, dtype=np.int64)
    # seeds stand in order at the ends of their buckets
    symbols = s[seeds]
    start[end[symbols] - (np.searchsorted(symbols, symbols, side="right") - np.arange(len(seeds)))] = seeds
    sa, head, tail = start.tolist(), (end - counts).tolist(), (end - 1).tolist()
    for p in sa:  # grows ahead of the loop
        c = larger[p]
        if c >= 0:
            at = head[c]
            sa[at] = p - 1
            head[c] = at + 1
    sa[0] = n - 1
    for p in reversed(sa):
        c = lesser[p]
        if c >= 0:
            at = tail[c]
            sa[at] = p - 1
            tail[c] = at - 1
    return np.array(sa, dtype=np.int64)


def _induce(s: np.ndarray, smaller: np.ndarray, counts: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Suffixes in order, by the order of ``seeds`` (LMS positions, sorted at least by symbol)."""
    return (_induce_buckets if len(s) >= PER_BUCKET * len(counts) else _induce_items)(s, smaller, counts, seeds)


def _names(s: np.ndarray, ranked: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Names of the LMS substrings, given in order with their sizes: equal ones share a name."""
    a, b = ranked[:-1], ranked[1:]
    new = size[a] != size[b]
    active, k = np.flatnonzero(~new), 0
    while len(active):
        differ = s[a[active] + k] != s[b[active] + k]
        new[active[differ]] = True
        k += 1
        active = active[~differ & (size[a[active]] > k)]
    return np.concatenate([[0], np.cumsum(new)])


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``s`` in order; ``s`` ends with its only 0, its least symbol."""
    n = len(s)
    if n <= 2:
        return np.arange(n)[::-1].copy()
    s = s.astype(np.int64)
    counts = np.bincount(s)
    smaller = _smaller(s)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    is_lms = np.zeros(n, dtype=bool)
    is_lms[lms] = True
    size = np.zeros(n, dtype=np.int64)
    size[lms[:-1]] = np.diff(lms) + 1
    size[lms[-1]] = 1
    rough = _induce(s, smaller, counts, lms[np.argsort(s[lms], kind="stable")])
    ranked = rough[is_lms[rough]]
    named = _names(s, ranked, size)
    if named[-1] + 1 == len(ranked):
        seeds = ranked
    else:
        name = np.zeros(n, dtype=np.int64)
        name[ranked] = named
        seeds = lms[suffix_array(name[lms])]
    return _induce(s, smaller, counts, seeds)


def permuted_prefixes(s: np.ndarray, sa: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(prefix, before) by position: letters shared with the suffix before it in ``sa`` (-1 for the first).

    Symbols up to ``ends`` (a symbol) end a string: no prefix goes past one.
    """
    n = len(s)
    before = np.full(n, -1, dtype=np.int64)
    before[sa[1:]] = sa[:-1]
    at = np.arange(n)
    left = np.where((at > 0) & (before > 0), s[at - 1], 0)
    fresh = (before <= 0) | (at == 0) | (left != s[np.maximum(before - 1, 0)]) | (left <= ends)
    fresh &= before >= 0
    begin = np.flatnonzero(fresh)
    other = before[begin]
    shared = np.zeros(len(begin), dtype=np.int64)
    # four symbols of two bytes a time, then one at a time
    narrow = np.concatenate([s, np.zeros(4, s.dtype)]).astype("<u2")
    ended = np.concatenate([s <= ends, np.ones(4, bool)])
    until = np.flatnonzero(ended)
    room = until[np.searchsorted(until, begin)] - begin
    wide = np.ndarray((n,), "<u8", narrow.tobytes(), strides=(2,))
    active = np.arange(len(begin))
    while len(active):
        same = (room[active] >= shared[active] + 4) & (wide[np.minimum(begin[active] + shared[active], n - 1)] == wide[np.minimum(other[active] + shared[active], n - 1)])
        active = active[same]
        shared[active] += 4
    active = np.arange(len(begin))
    while len(active):
        same = (room[active] > shared[active]) & (narrow[begin[active] + shared[active]] == narrow[other[active] + shared[active]])
        active = active[same]
        shared[active] += 1
    prefix = np.zeros(n, dtype=np.int64)
    if len(begin):
        source = np.searchsorted(begin, at, side="right") - 1
        known = source >= 0
        prefix[known] = np.maximum(0, shared[source[known]] - (at[known] - begin[source[known]]))
    prefix[before < 0] = 0
    return prefix, before
