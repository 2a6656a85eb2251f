"""Suffix arrays by induced sorting, and permuted common prefixes, over numpy arrays."""

from __future__ import annotations

import numpy as np

def s_types(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is less than the next one; the last one is not, for the empty suffix is least."""
    n = len(s)
    rises = np.empty(n, np.int8)
    rises[:-1] = np.sign(s[1:].astype(np.int32) - s[:-1])
    rises[-1] = -1
    # equal neighbours take the type of the next place where the text changes
    at = np.where(rises != 0, np.arange(n), n)
    at = np.minimum.accumulate(at[::-1])[::-1]
    return rises[at] > 0


def spread(sa: np.ndarray, chars: np.ndarray, places: np.ndarray, ends: np.ndarray, down: bool) -> None:
    """Puts suffixes, in order, at the free ends of the buckets of their first characters."""
    if len(chars) > 1:
        order = chars.argsort(kind="stable")
        places, chars = places[order], chars[order]
        rank = np.arange(len(chars)) - chars.searchsorted(chars)
    else:
        rank = 0
    # of equal characters the last one's place stays as the new end
    if down:
        at = ends[chars] - 1 - rank
        sa[at] = places
        ends[chars] = at
    else:
        at = ends[chars] + rank
        sa[at] = places
        ends[chars] = at + 1


def stretches(sources: np.ndarray, targets: np.ndarray, k: int) -> list[tuple[int, int, bool]]:
    """Stretches of buckets, in order, that can be gone through at once: no bucket of one gets anything from a bucket of the same one.

    sources and targets: the buckets from which and to which each suffix comes, to the same or a later
    one. A bucket that gets something from itself is a stretch of its own; the third value tells.
    """
    until = np.full(k + 1, k)
    np.minimum.at(until, sources.astype(np.int64), targets.astype(np.int64))
    until = np.minimum.accumulate(until[::-1])[::-1].tolist()
    out, c = [], 0
    while c < k:
        end = max(until[c], c + 1)
        out.append((c, end, until[c] == c))
        c = end
    return out


def induce(s: np.ndarray, k: int, is_s: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """All suffixes in the order that sorted leftmost-smaller suffixes induce: larger ones forwards, smaller ones backwards.

    Buckets are taken in turn, as many at once as get nothing from each other. What a bucket gets from
    itself, runs of one character, comes in waves. Every suffix is put in its place once a direction, so
    the time is linear in the text whatever the alphabet.
    """
    n = len(s)
    sa = np.full(n, -1, np.int32)
    ends = np.cumsum(np.bincount(s, minlength=k))
    starts = np.append(0, ends[:-1])
    heads, tails, bounds = starts.copy(), ends.copy(), np.append(starts, n).tolist()

    def go(found: np.ndarray, smaller: bool) -> None:
        before = found[found > 0] - 1
        before = before[is_s[before] == smaller]
        if len(before):
            spread(sa, s[before], before, tails if smaller else heads, smaller)

    if len(lms):
        spread(sa, s[lms[::-1]], lms[::-1], ends.copy(), True)
    # the empty suffix comes first, and before it stands the last one, which is larger
    spread(sa, s[n - 1 :], np.array([n - 1]), heads, False)
    larger = np.flatnonzero(~is_s[:-1])
    for c, end, to_itself in stretches(s[larger + 1], s[larger], k):
        done, upto = bounds[c], bounds[end]
        if done == upto:
            continue
        if to_itself:
            while done < heads[c]:
                wave = sa[done : heads[c]]
                done = int(heads[c])
                go(wave, False)
        go(sa[done:upto], False)
    sa[(sa >= 0) & is_s[sa]] = -1
    smaller = np.flatnonzero(is_s)
    for c, end, to_itself in stretches(k - 1 - s[smaller + 1], k - 1 - s[smaller], k):
        start, done = bounds[k - end], bounds[k - c]
        if start == done:
            continue
        if to_itself:
            while done > tails[k - end]:
                wave = sa[tails[k - end] : done][::-1]
                done = int(tails[k - end])
                go(wave, True)
        go(sa[start:done][::-1], True)
    return sa


def names(s: np.ndarray, sorted_lms: np.ndarray, lms: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers of the leftmost-smaller substrings, in text order, equal for equal ones, from their sorted order."""
    n, m = len(s), len(lms)
    nth = np.empty(n, np.int64)
    nth[lms] = np.arange(m)
    length = np.diff(np.append(lms, n - 1)) + 1
    a, b = sorted_lms[:-1], sorted_lms[1:]
    la, lb = length[nth[a]], length[nth[b]]
    # the last substring ends with the text, so no other equals it
    same = (la == lb) & (nth[a] < m - 1) & (nth[b] < m - 1)
    live, j = np.flatnonzero(same), 0
    while len(live):
        equal = s[a[live] + j] == s[b[live] + j]
        same[live[~equal]] = False
        j += 1
        live = live[equal & (la[live] > j)]
    number = np.concatenate([[0], np.cumsum(~same)])
    out = np.empty(m, np.int64)
    out[nth[sorted_lms]] = number
    return out, int(number[-1]) + 1


def suffix_array(s: np.ndarray, k: int) -> np.ndarray:
    """Order of the suffixes of s, whose values are below k.

    Leftmost-smaller substrings are sorted by induction, numbered, and the text of their numbers is
    sorted the same way, down to a text without repeated numbers; the order of each text induces that
    of the one above it, in linear time.
    """
    n = len(s)
    if n < 2:
        return np.arange(n)
    # 16 bits are sorted by radix
    s = s.astype(np.uint16 if k <= 1 << 16 else np.int32, copy=False)
    is_s = s_types(s)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    if not len(lms):
        return induce(s, k, is_s, lms)
    first = induce(s, k, is_s, lms)
    mark = np.zeros(n, bool)
    mark[lms] = True
    text, m = names(s, first[mark[first]], lms)
    order = np.argsort(text) if m == len(lms) else suffix_array(text, m)
    return induce(s, k, is_s, lms[order])


def permuted_common_prefixes(s: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """At each place the common prefix of its suffix with the one before it in sa; prefixes end before a 0.

    Where the characters in front of both are equal, the prefix is one less than that of the place
    before. Only the others are compared, in steps of eight.
    """
    n = len(s)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    places = np.arange(n)
    known = np.flatnonzero((phi > 0) & (places > 0))
    derived = np.zeros(n, bool)
    derived[known] = (s[known - 1] == s[phi[known] - 1]) & (s[known - 1] > 0)
    out = np.zeros(n, np.int64)
    live, at, ahead = np.flatnonzero(~derived & (phi >= 0)), 0, np.arange(8)
    padded = np.concatenate([s, np.zeros(8, s.dtype)])
    while len(live):
        x = padded[np.minimum(live + at, n)[:, None] + ahead]
        equal = (x == padded[np.minimum(phi[live] + at, n)[:, None] + ahead]) & (x > 0)
        run = np.where(equal.all(1), 8, equal.argmin(1))
        out[live] += run
        at += 8
        live = live[run == 8]
    last = np.maximum.accumulate(np.where(~derived, places, -1))
    return np.where(derived, np.maximum(out[last] - (places - last), 0), out)
