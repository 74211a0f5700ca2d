"""Suffix arrays by induced sorting, and permuted common prefixes.

A suffix is S-type if it is smaller than the next one, else L-type; an S after an L is leftmost-smaller (LMS). The LMS
substrings are sorted by one induction and named; where names repeat, the suffixes of the string of names, a third as
long, are sorted by ranks that are doubled. A second induction from the sorted LMS suffixes gives all suffixes. A bucket's
entries are induced together, as arrays. Induction is linear; doubling takes a round for each power of two up to the
longest common prefix in names, and looks at what is still tied only."""

from __future__ import annotations

import numpy as np


def _types(t: np.ndarray) -> np.ndarray:
    """True where S-type. The last symbol is the one smallest."""
    n = len(t)
    ends = np.append(np.flatnonzero(t[1:] != t[:-1]), n - 1)
    rising = np.append(t[ends[:-1] + 1] > t[ends[:-1]], True)
    return np.repeat(rising, np.diff(ends, prepend=-1))


def _spread(sa: np.ndarray, at: np.ndarray, given: np.ndarray, symbols: np.ndarray, step: int) -> None:
    """Puts given, in order, at its symbols' next free places."""
    order = np.argsort(symbols, kind="stable")
    symbols = symbols[order]
    counts = np.bincount(symbols, minlength=len(at))
    first = np.cumsum(counts) - counts
    sa[at[symbols] + step * (np.arange(len(symbols)) - first[symbols])] = given[order]
    at += step * counts


def _induced(t: np.ndarray, s: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """lms: the LMS positions in the order to induce from -> all positions, in induced order."""
    n, k = len(t), len(sizes)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    sa = np.full(n, -1, np.int32)
    by = t[lms]
    order = np.argsort(by, kind="stable")
    seeds, bounds = lms[order], np.searchsorted(by[order], np.arange(k + 1))
    heads = starts.copy()
    for c in np.flatnonzero(sizes):
        done = starts[c]
        while True:
            if done < heads[c]:
                got, done, last = sa[done : heads[c]], heads[c], False
            else:
                got, last = seeds[bounds[c] : bounds[c + 1]], True
            before = got[got > 0] - 1
            before = before[~s[before]]
            if len(before):
                _spread(sa, heads, before, t[before], 1)
            if last:
                break
    tails = ends - 1
    for c in np.flatnonzero(sizes)[::-1]:
        done = ends[c] - 1
        while True:
            if done > tails[c]:
                got, done, last = sa[tails[c] + 1 : done + 1][::-1], tails[c], False
            else:
                got, last = sa[starts[c] : heads[c]][::-1], True
            before = got[got > 0] - 1
            before = before[s[before]]
            if len(before):
                _spread(sa, tails, before, t[before], -1)
            if last:
                break
    sa[0] = n - 1
    return sa


def _by_ranks(names: np.ndarray) -> np.ndarray:
    """Suffix array of names: ranks by one name, then by twice as many each time; only what still shares a rank is sorted again."""
    n = len(names)
    left = np.argsort(names, kind="stable")
    key, rank, reach = names[left], np.zeros(n, np.int64), 0
    while len(left):
        fresh = np.append(True, key[1:] != key[:-1])
        first = np.flatnonzero(fresh)
        if reach:
            group = rank[left]
            group_first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            sizes = np.diff(group_first, append=len(left))
            rank[left] = group - np.repeat(group_first, sizes) + np.repeat(first, np.diff(first, append=len(left)))
        else:
            rank[left] = np.repeat(first, np.diff(first, append=n))
        left = left[~(fresh & np.append(fresh[1:], True))]
        reach = 2 * reach or 1
        after = left + reach
        key = rank[left] << 32 | np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        order = np.argsort(key, kind="stable")
        left, key = left[order], key[order]
    out = np.empty(n, np.int32)
    out[rank] = np.arange(n, dtype=np.int32)
    return out


def _names(t: np.ndarray, lms: np.ndarray, sorted_lms: np.ndarray) -> tuple[np.ndarray, int]:
    """A name for each LMS substring, in the order of positions; equal substrings share it."""
    n = len(t)
    nth = np.empty(n, np.int32)
    nth[lms] = np.arange(len(lms), dtype=np.int32)
    spans = np.diff(lms, append=n - 1) + 1
    spans[-1] = 1
    k = nth[sorted_lms]
    a, b, size = sorted_lms[1:], sorted_lms[:-1], spans[k[1:]]
    same = size == spans[k[:-1]]
    left = np.flatnonzero(same)
    for at in range(int(spans.max())):
        left = left[at < size[left]]
        if not len(left):
            break
        off = t[a[left] + at] != t[b[left] + at]
        same[left[off]] = False
        left = left[~off]
    out = np.empty(len(lms), np.int32)
    out[k] = np.concatenate([[0], np.cumsum(~same)])
    return out, int((~same).sum()) + 1


def _sorted(t: np.ndarray, k: int) -> np.ndarray:
    """Suffix array of t, symbols below k, ending with its only 0."""
    n = len(t)
    if n < 3:
        return np.arange(n - 1, -1, -1, dtype=np.int32)
    s = _types(t)
    lms = (np.flatnonzero(s[1:] & ~s[:-1]) + 1).astype(np.int32)
    sizes = np.bincount(t, minlength=k)
    first = _induced(t, s, lms, sizes)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    named, most = _names(t, lms, first[is_lms[first]])
    order = _by_ranks(named) if most < len(lms) else np.argsort(named).astype(np.int32)
    return _induced(t, s, lms[order], sizes)


def suffix_array(data: np.ndarray) -> np.ndarray:
    """data: symbols from 0 to 256 -> start of each suffix, in order; a suffix that ends is smaller than its continuations."""
    return _sorted(np.append(data.astype(np.int32) + 1, 0).astype(np.int32), 259)[1:]


def common_prefixes(data: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each place of the suffix array, the length of the common prefix with the suffix before it.

    Permuted by position, the lengths fall by one from place to place, but where the symbols before the two suffixes
    differ; only those are compared."""
    n = len(sa)
    if n == 0:
        return np.zeros(0, np.int32)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    here = np.arange(n)
    bare = (phi < 1) | (here == 0)
    bare[~bare] = data[here[~bare] - 1] != data[phi[~bare] - 1]
    at = np.flatnonzero(bare)
    length = np.zeros(len(at), np.int64)
    padded = np.concatenate([data, np.zeros(8, data.dtype)])
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
    left = np.flatnonzero(phi[at] >= 0)
    while len(left):
        p, q = at[left] + length[left], phi[at[left]] + length[left]
        room = np.minimum(n - np.maximum(p, q), 8)
        same = eight[np.minimum(p, n)] == eight[np.minimum(q, n)]
        run = np.minimum(np.where(same.all(1), 8, np.argmin(same, 1)), np.maximum(room, 0))
        length[left] += run
        left = left[run == 8]
    owner = np.cumsum(bare) - 1
    plcp = length[owner] - (here - at[owner])
    return plcp[sa].astype(np.int32)
