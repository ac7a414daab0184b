"""Suffix arrays by induced sorting, and permuted common prefixes, over numpy arrays.

Suffixes are classified as smaller (S) or larger (L) than their right neighbour.  The
leftmost S suffixes of each run (LMS) are sorted first: their substrings by one round of
induction, then, named by rank, by pairing names with those 1, 2, 4 ... places on, which
sorts the reduced string recursively.  From the sorted LMS suffixes the L suffixes are
induced in one scan up and the S suffixes in one scan down.  A scan takes a bucket (a
first character) at a time, and within it the entries that it adds to itself round by
round, so that each entry is touched once and all work on many entries is one numpy
call: linear in the text, for alphabets of bytes.

Orders are needed to a stated depth only: suffixes that agree on their first ``depth``
characters stand together, in any order.
"""

from __future__ import annotations

import numpy as np


def classify(s: np.ndarray) -> np.ndarray:
    """True where the suffix is of type S.  The last character has to be the least and alone."""
    n = len(s)
    step = np.sign(np.diff(s.astype(np.int32)))  # the sign at the end of a run of equal characters holds for all of it
    at = np.where(step != 0, np.arange(n - 1), n)
    at = np.minimum.accumulate(at[::-1])[::-1]
    out = np.ones(n, bool)
    out[:-1] = step[np.minimum(at, n - 2)] > 0
    return out


def _append(sa: np.ndarray, heads: np.ndarray, s: np.ndarray, items: np.ndarray, direction: int) -> None:
    """Put ``items`` at the heads of the buckets of their first characters, in order."""
    chars = s[items]
    order = np.argsort(chars, kind="stable")
    chars, items = chars[order], items[order]
    first = np.concatenate(([0], np.nonzero(np.diff(chars))[0] + 1))
    counts = np.diff(np.append(first, len(chars)))
    which = chars[first]
    rank = np.arange(len(chars)) - np.repeat(first, counts)
    sa[np.repeat(heads[which], counts) + direction * rank] = items
    heads[which] += direction * counts


def induce(s: np.ndarray, smaller: np.ndarray, starts: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The suffix array that follows from ``lms``, LMS suffixes in order.  ``starts`` are the buckets' bounds."""
    n, size = len(s), len(starts) - 1
    sa = np.full(n, -1, np.int64)
    chars = s[lms]
    cuts = np.searchsorted(chars, np.arange(size + 1))  # lms is in order of its first characters
    heads = starts[:-1].copy()
    used = np.nonzero(np.diff(starts))[0]
    for c in used:
        at = starts[c]
        while at < heads[c]:
            end = heads[c]
            before = sa[at:end] - 1
            before = before[before >= 0]
            before = before[~smaller[before]]
            if len(before):
                _append(sa, heads, s, before, 1)
            at = end
        part = lms[cuts[c] : cuts[c + 1]] - 1
        part = part[part >= 0]
        if len(part):
            _append(sa, heads, s, part, 1)
    larger_ends = heads
    tails = starts[1:] - 1
    for c in used[::-1]:
        at = starts[c + 1] - 1
        while at > tails[c]:
            end = tails[c]
            before = sa[end + 1 : at + 1][::-1] - 1
            before = before[before >= 0]
            before = before[smaller[before]]
            if len(before):
                _append(sa, tails, s, before, -1)
            at = end
        part = sa[starts[c] : larger_ends[c]][::-1] - 1
        part = part[part >= 0]
        part = part[smaller[part]]
        if len(part):
            _append(sa, tails, s, part, -1)
    # The last suffix, alone in the least bucket, is induced by none.
    sa[0] = n - 1
    return sa


def _rank_lms(s: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Rank (place of the first equal one) of each LMS substring, given their order."""
    n = len(s)
    ends = np.append(lms[1:], n - 1)
    place = np.full(n, -1, np.int64)
    place[lms] = np.arange(len(lms))
    order = place[ordered]
    lengths = (ends - lms)[order] + 1
    new = np.ones(len(order), bool)
    new[1:] = lengths[1:] != lengths[:-1]
    open_ = np.nonzero(~new)[0]
    k = 0
    while len(open_):
        left = open_[lengths[open_] > k]
        differs = s[ordered[left] + k] != s[ordered[left - 1] + k]
        new[left[differs]] = True
        open_ = left[~differs]
        k += 1
    ranks = np.empty(len(lms), np.int64)
    ranks[order] = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return ranks


def _sort_reduced(ranks: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of the string of names, by names as far as ``depth`` of them."""
    n = len(ranks)
    ranks = np.append(ranks, -1)
    step = 1
    open_ = np.nonzero(np.bincount(ranks[:-1], minlength=n)[ranks[:-1]] > 1)[0]
    while len(open_) and step < depth:
        follow = ranks[np.minimum(open_ + step, n)]
        order = np.lexsort((follow, ranks[open_]))
        items, group, follow = open_[order], ranks[open_][order], follow[order]
        place = np.arange(len(items))
        group_new = np.append(True, group[1:] != group[:-1])
        part_new = group_new | np.append(True, follow[1:] != follow[:-1])
        group_start = np.maximum.accumulate(np.where(group_new, place, 0))
        part_start = np.maximum.accumulate(np.where(part_new, place, 0))
        ranks[items] = group + part_start - group_start
        sizes = np.diff(np.append(np.nonzero(part_new)[0], len(items)))
        open_ = items[np.repeat(sizes, sizes) > 1]
        step *= 2
    return np.argsort(ranks[:-1], kind="stable")


def suffix_array(s: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``s`` (small unsigned integers, the last one least and alone) in order to ``depth`` characters."""
    n = len(s)
    if n < 2:
        return np.arange(n)
    smaller = classify(s)
    starts = np.concatenate(([0], np.cumsum(np.bincount(s, minlength=int(s.max()) + 1))))
    lms = np.nonzero(smaller[1:] & ~smaller[:-1])[0] + 1
    first = lms[np.argsort(s[lms], kind="stable")]
    rough = induce(s, smaller, starts, first)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    ordered = rough[is_lms[rough]]
    ranks = _rank_lms(s, lms, ordered)
    # An LMS substring has two characters at least before the next begins.
    order = _sort_reduced(ranks, depth // 2 + 1)
    return induce(s, smaller, starts, lms[order])


def common_prefixes(s: np.ndarray, sa: np.ndarray, depth: int) -> np.ndarray:
    """Permuted common prefixes: for each suffix, by its place in ``s``, how many characters it shares with the one before it in order, ``depth`` at most."""
    n = len(s)
    before = np.full(n, n, np.int64)
    before[sa[1:]] = sa[:-1]
    padded = np.zeros(n + depth + 8, np.uint8 if s.dtype == np.uint8 else np.uint16)
    padded[:n] = s
    out = np.zeros(n, np.int32)
    open_ = np.nonzero(before < n)[0]
    other = before[open_]
    width = 8 // padded.itemsize
    # Eight bytes from every place, read as one number.
    words = np.lib.stride_tricks.as_strided(padded.view(np.uint8), (n + depth, 8), (padded.itemsize, 1))
    words = np.ascontiguousarray(words).view(np.uint64).ravel()
    for k in range(0, depth, width):
        same = words[np.minimum(open_ + k, len(words) - 1)] == words[np.minimum(other + k, len(words) - 1)]
        done, done_other = open_[~same], other[~same]
        shared = np.full(len(done), k, np.int32)
        running = np.ones(len(done), bool)
        for j in range(width):
            running &= padded[np.minimum(done + k + j, n)] == padded[np.minimum(done_other + k + j, n)]
            shared += running
        out[done] = np.minimum(shared, depth)
        open_, other = open_[same], other[same]
    out[open_] = depth
    return np.minimum(out, n - np.arange(n))
