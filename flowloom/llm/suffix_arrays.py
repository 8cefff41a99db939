"""Suffix arrays by induced sorting, and permuted common prefixes.

Suffixes are classified as L (larger than the next) or S; the leftmost S of each run
(LMS) start substrings that are sorted and named by comparing several symbols at once
(by inducing, if many are long and alike) and, unless all names differ, ordered by
the suffix array of the names, which is made the same way. From the ordered LMS suffixes the L suffixes are
induced bucket by bucket from the least symbol up, then the S suffixes from the
greatest down. A level of few symbols (bytes) is induced with numpy: all suffixes
that one bucket (or one round of equal symbols in it) induces are placed at once. A
level of many symbols (names), whose buckets hold few suffixes each, is induced
suffix by suffix. Both take time linear in the string.
"""

from __future__ import annotations

import numpy as np

#: Suffixes for each symbol from which on a level is induced a bucket at a time, and symbols for which it always is.
SUFFIXES, SYMBOLS = 200, 300


def _induced(s: np.ndarray, is_s: np.ndarray, counts: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """All suffixes in order, from LMS suffixes (or substrings) in order."""
    n, k = len(s), len(counts)
    ends = np.cumsum(counts)
    begins = ends - counts
    out = np.full(n, -1, np.int64)
    head, tail = begins.copy(), ends.copy()
    lms_bucket = s[lms]
    lms_at = np.searchsorted(lms_bucket, np.arange(k + 1))

    def put(j: np.ndarray, forward: bool) -> None:
        symbol = s[j]
        order = np.argsort(symbol, kind="stable")
        j, symbol = j[order], symbol[order]
        first = np.flatnonzero(np.concatenate([[True], symbol[1:] != symbol[:-1]]))
        sizes = np.diff(first, append=len(j))
        within = np.arange(len(j)) - np.repeat(first, sizes)
        into = symbol[first]
        if forward:
            out[np.repeat(head[into], sizes) + within] = j
            head[into] += sizes
        else:
            out[np.repeat(tail[into], sizes) - 1 - within] = j
            tail[into] -= sizes

    for c in np.flatnonzero(counts).tolist():
        at = begins[c]
        while at < head[c]:
            stop = head[c]
            j = out[at:stop] - 1
            j = j[j >= 0]
            j = j[~is_s[j]]
            at = stop
            if len(j):
                put(j, True)
        if lms_at[c] < lms_at[c + 1]:
            j = lms[lms_at[c] : lms_at[c + 1]] - 1
            put(j[j >= 0], True) if (j >= 0).any() else None
    for c in np.flatnonzero(counts)[::-1].tolist():
        at = ends[c]
        while at > tail[c]:
            stop = tail[c]
            j = out[stop:at][::-1] - 1
            j = j[j >= 0]
            j = j[is_s[j]]
            at = stop
            if len(j):
                put(j, False)
        if begins[c] < head[c]:
            j = out[begins[c] : head[c]][::-1] - 1
            j = j[j >= 0]
            j = j[is_s[j]]
            if len(j):
                put(j, False)
    if out[0] < 0:  # the sentinel, which nothing induces
        out[0] = n - 1
    return out


def _induced_singly(s: np.ndarray, is_s: np.ndarray, counts: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """As _induced(), a suffix at a time: for many symbols with few suffixes each."""
    n = len(s)
    ends = np.cumsum(counts)
    # LMS suffixes at the tails of their buckets
    out = np.full(n, -1, np.int64)
    bucket = s[lms]
    first = np.searchsorted(bucket, bucket)
    size = np.searchsorted(bucket, bucket, side="right") - first
    out[ends[bucket] - size + np.arange(len(lms)) - first] = lms
    at, head, tail = out.tolist(), (ends - counts).tolist(), ends.tolist()
    # the symbol before each suffix if it is induced, else -1; the last of the list is for places without a suffix (-1)
    before, larger = np.full((2, n + 1), -1), ~is_s[:-1]
    before[0, 1:n][larger], before[1, 1:n][~larger] = s[:-1][larger], s[:-1][~larger]
    of = before[0].tolist()
    for j in at:  # grows while it is read
        c = of[j]
        if c >= 0:
            at[head[c]] = j - 1
            head[c] += 1
    of = before[1].tolist()
    for j in reversed(at):
        c = of[j]
        if c >= 0:
            tail[c] = i = tail[c] - 1
            at[i] = j - 1
    at[0] = n - 1  # the sentinel, which nothing induces
    return np.array(at, np.int64)


#: Rounds of comparing LMS substrings, after which what is long and alike is sorted by inducing.
ROUNDS = 64


def _substrings_sorted(s: np.ndarray, lms: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray] | None:
    """LMS positions by their substrings and numbers of these, the same for equal ones; as many symbols as a word holds are compared at once. None if many rounds don't tell them apart."""
    bits = (symbols + 1).bit_length()
    each = 63 // bits
    reach = np.append(lms[1:], len(s) - 1) + 1 - lms
    # behind its end a substring has a symbol above all: where it is the start of another, its last symbol begins an S suffix, the other's there an L suffix, which is less
    beyond = symbols

    def words(at: np.ndarray, done: int) -> np.ndarray:
        key = np.zeros(len(at), np.int64)
        for j in range(done, done + each):
            inside = j < reach[at]
            key = (key << bits) | np.where(inside, s.take(lms[at] + j, mode="clip"), beyond)
        return key

    order = np.arange(len(lms))
    key = words(order, 0)
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    for done in range(each, each * ROUNDS, each):
        # those that are equal to a neighbour so far and longer, or end just here, and so come behind longer ones
        same = np.flatnonzero(~new)
        tied = np.zeros(len(order), bool)
        tied[same], tied[same - 1] = True, True
        tied &= reach[order] >= done
        where = np.flatnonzero(tied)
        if not len(where):
            return lms[order], np.cumsum(new) - 1
        group = np.cumsum(new)[where]
        at = order[where]
        key = words(at, done)
        by = np.lexsort((key, group))
        order[where] = at[by]
        key, fresh = key[by], np.concatenate([[True], group[1:] != group[:-1]])
        new[where] = fresh | np.concatenate([[True], key[1:] != key[:-1]])
    return None


def _named(s: np.ndarray, lms: np.ndarray, sorted_lms: np.ndarray) -> np.ndarray:
    """Numbers of LMS substrings in their order, the same for equal ones. A substring reaches to the next LMS position, inclusive."""
    reach = np.zeros(len(s), np.int64)
    reach[lms] = np.append(lms[1:], len(s) - 1) + 1 - lms
    a, b = sorted_lms[:-1], sorted_lms[1:]
    new = reach[a] != reach[b]
    same = np.flatnonzero(~new)
    if len(same):
        sizes = reach[a[same]]
        starts = np.cumsum(sizes) - sizes
        within = np.arange(int(sizes.sum())) - np.repeat(starts, sizes)
        equal = s[np.repeat(a[same], sizes) + within] == s[np.repeat(b[same], sizes) + within]
        new[same] = ~np.logical_and.reduceat(equal, starts)
    return np.cumsum(np.concatenate([[0], new]))


def suffix_array(s: np.ndarray, symbols: int) -> np.ndarray:
    """Order of the suffixes of s, whose last symbol is its only 0; symbols are below the given number."""
    n = len(s)
    if n <= 2:
        return np.arange(n)[::-1].copy()
    induced = _induced_singly if symbols > max(SYMBOLS, n // SUFFIXES) else _induced
    # S where the next different symbol is greater; the sentinel is S
    index = np.arange(n - 1)
    change = np.where(s[:-1] != s[1:], index, n)
    following = np.minimum.accumulate(change[::-1])[::-1]
    is_s = np.ones(n, bool)
    is_s[:-1] = s[following] < s[following + 1]
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    counts = np.bincount(s, minlength=symbols)
    found = _substrings_sorted(s, lms, symbols)
    if found is None:
        order = induced(s, is_s, counts, lms[np.argsort(s[lms], kind="stable")])
        starts = np.zeros(n, bool)
        starts[lms] = True
        sorted_lms = order[starts[order]]
        found = sorted_lms, _named(s, lms, sorted_lms)
    sorted_lms, name = found
    if name[-1] + 1 < len(lms):
        names = np.zeros(n, np.int64)
        names[sorted_lms] = name
        sorted_lms = lms[suffix_array(names[lms], int(name[-1]) + 1)]
    return induced(s, is_s, counts, sorted_lms)


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int, where: np.ndarray | None = None) -> np.ndarray:
    """For every position of data (bytes, at least `most` of them after any position that counts), the common prefix with the suffix before it in order, up to `most`: in text order, not suffix order. where: only for these positions with such a one before them, 0 for others."""
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    wide = np.ndarray(n, "<u8", padded, strides=(1,))
    out = np.zeros(n, np.int64)
    live = np.flatnonzero(before >= 0) if where is None else np.flatnonzero(where & (before >= 0) & where[before])
    other = before[live]
    for k in range(0, most, 8):
        a, b = live + k, other + k
        inside = np.maximum(a, b) < n
        if not inside.all():
            live, other, a, b = live[inside], other[inside], a[inside], b[inside]
        x = wide.take(a) ^ wide.take(b)
        same = x == 0
        differs = ~same
        low = x[differs]
        out[live[differs]] = k + (np.log2((low & (~low + np.uint64(1))).astype(np.float64)) // 8).astype(np.int64)
        live, other = live[same], other[same]
        out[live] = k + 8
        if not len(live):
            break
    return np.minimum(out, most)
