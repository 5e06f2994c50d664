"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

Suffixes are classified as smaller (S) or larger (L) than the next one. The
leftmost-smaller (LMS) substrings are sorted by induction and named; the string
of names is sorted recursively; a second induction gives all suffixes in linear
work. An induction goes through the buckets of the alphabet and moves a whole
bucket at a time. Reduced strings over more than ``WIDE`` names, or with fewer
than ``BUCKET`` suffixes a name, are sorted by doubling of ranks instead (on the
suffixes that are still tied): small buckets leave little to do at a time. Two
inductions take about 0.2 ms a bucket, doubling about 1 us a suffix (12,713
suffixes of 1494 names: 1.7 s by induction, 0.01 s by doubling).
"""

from __future__ import annotations

import numpy as np

WIDE = 2048
BUCKET = 256


def by_doubling(t: np.ndarray) -> np.ndarray:
    """Suffix array of a string of small integers; only tied suffixes are sorted again."""
    n = len(t)
    order = np.argsort(t, kind="stable")
    new = np.r_[True, t[order[1:]] != t[order[:-1]]]
    start = np.flatnonzero(new)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(start, np.diff(np.r_[start, n]))  # rank: first place of the group
    size = np.diff(np.r_[start, n])
    tied = order[np.repeat(size > 1, size)]
    h = 1
    while len(tied):
        nxt = tied + h
        second = np.where(nxt < n, rank[np.minimum(nxt, n - 1)], -1)
        first = rank[tied]
        o = np.lexsort((second, first))
        tied, first, second = tied[o], first[o], second[o]
        lead = np.r_[True, first[1:] != first[:-1]]
        split = lead | np.r_[True, second[1:] != second[:-1]]
        at = np.arange(len(tied))
        group_first = np.maximum.accumulate(np.where(lead, at, 0))
        part_first = np.maximum.accumulate(np.where(split, at, 0))
        rank[tied] = first + part_first - group_first
        part = np.flatnonzero(split)
        size = np.diff(np.r_[part, len(tied)])
        tied = tied[np.repeat(size > 1, size)]
        h *= 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


def types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last is larger than the end."""
    n = len(t)
    s = np.zeros(n, bool)
    if n > 1:
        less, same = t[:-1] < t[1:], t[:-1] == t[1:]
        at = np.where(same, n - 1, np.arange(n - 1))
        nxt = np.minimum.accumulate(at[::-1])[::-1]  # where the run of equal symbols ends
        s[:-1] = np.r_[less, False][nxt]
    return s


def _push(sa, t, take, place, step):
    """Put the suffixes ``take`` at their buckets' free places, in order; ``step`` is 1 at heads, -1 at tails."""
    c = t[take]
    order = np.argsort(c, kind="stable")
    c, take = c[order], take[order]
    start = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
    size = np.diff(np.r_[start, len(c)])
    within = np.arange(len(c)) - np.repeat(start, size)
    sa[place[c] + step * within] = take
    place[c[start]] += step * size


def _runs_back(batch: np.ndarray, run: np.ndarray) -> np.ndarray:
    """What the suffixes of one bucket induce in their own bucket: the earlier places of their runs of equal symbols, nearest first."""
    r = batch - run[batch]
    total = int(r.sum())
    if not total:
        return batch[:0]
    which = np.repeat(np.arange(len(batch)), r)
    back = np.arange(total) - np.repeat(np.cumsum(r) - r, r) + 1
    order = np.argsort(back, kind="stable")
    return batch[which[order]] - back[order]


def induce(t: np.ndarray, s: np.ndarray, lms: np.ndarray, k: int) -> np.ndarray:
    """All suffixes from the LMS suffixes in sorted order (or in any order inside a bucket, to sort LMS substrings)."""
    n = len(t)
    count, smaller = np.bincount(t, minlength=k), np.bincount(t[s], minlength=k)
    begin = np.cumsum(count) - count
    end = begin + count
    larger_end = end - smaller
    run = np.maximum.accumulate(np.where(np.r_[True, t[1:] != t[:-1]], np.arange(n, dtype=np.int32), 0))
    sa = np.full(n, -1, np.int32)
    head, tail = begin.copy(), end - 1
    marks = np.bincount(t[lms], minlength=k)
    lms = lms[np.argsort(t[lms], kind="stable")]
    lms_at = np.r_[0, np.cumsum(marks)]
    used = np.flatnonzero(count).tolist()
    _push(sa, t, np.array([n - 1]), head, 1)  # the suffix before the end
    for c in used:
        own = sa[begin[c] : head[c]]
        own = np.concatenate([own, _runs_back(own, run)])
        sa[begin[c] : begin[c] + len(own)] = own
        before = own[own > 0] - 1
        before = np.concatenate([before[~s[before] & (t[before] != c)], lms[lms_at[c] : lms_at[c + 1]] - 1])
        if len(before):
            _push(sa, t, before, head, 1)
    for c in used[::-1]:
        own = sa[tail[c] + 1 : end[c]][::-1]
        own = np.concatenate([own, _runs_back(own, run)])
        sa[end[c] - len(own) : end[c]] = own[::-1]
        both = np.concatenate([own, sa[begin[c] : larger_end[c]][::-1]])
        before = both[both > 0] - 1
        before = before[s[before] & (t[before] != c)]
        if len(before):
            _push(sa, t, before, tail, -1)
    return sa


def _names(t: np.ndarray, order: np.ndarray, nxt: np.ndarray) -> tuple[np.ndarray, int]:
    """Names, by position, of sorted LMS substrings; ``nxt`` is where the next one starts (n for the last)."""
    n = len(t)
    a, b = order[:-1], order[1:]
    la, lb = nxt[a] - a, nxt[b] - b
    same = (la == lb) & (nxt[a] < n) & (nxt[b] < n)
    live = np.flatnonzero(same)
    j = 0
    while len(live):
        differ = t[a[live] + j] != t[b[live] + j]
        same[live[differ]] = False
        live = live[~differ]
        j += 1
        live = live[la[live] >= j]  # the closing symbol counts too
    name = np.empty(n, np.int64)
    number = np.r_[0, np.cumsum(~same)]
    name[order] = number
    return name, int(number[-1]) + 1 if len(order) else 0


def suffix_array(t: np.ndarray, k: int = 256) -> np.ndarray:
    """The suffix array of ``t`` (symbols from 0 to k - 1)."""
    n = len(t)
    if n <= 32 or k > WIDE:
        return by_doubling(t)
    s = types(t)
    lms = np.flatnonzero(s[1:] & ~s[:-1]) + 1
    if not len(lms):
        return induce(t, s, lms, k)
    sa = induce(t, s, lms, k)
    mark = np.zeros(n, bool)
    mark[lms] = True
    order = sa[mark[sa]]
    nxt = np.full(n, n, np.int64)
    nxt[lms[:-1]] = lms[1:]
    name, names = _names(t, order, nxt)
    if names < len(lms):
        reduced = name[lms]
        order = lms[suffix_array(reduced, names) if names * BUCKET <= len(reduced) else by_doubling(reduced)]
    return induce(t, s, order, k)


def words_at(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one number (zero bytes behind the end)."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    return np.ndarray((len(raw) + 1,), "<u8", padded.tobytes(), strides=(1,))


def permuted_prefixes(raw: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """PLCP: for each position, the common prefix with the suffix before it in order (0 for the first).

    Only irreducible values are compared byte by byte: where the symbols before
    both suffixes are equal, the value is that of the position before less one.
    """
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    at = np.arange(n)
    irreducible = (phi < 1) | (at == 0)
    rest = np.flatnonzero(~irreducible)
    irreducible[rest] = raw[rest - 1] != raw[phi[rest] - 1]
    i = np.flatnonzero(irreducible & (phi >= 0))
    j = phi[i]
    length = np.zeros(len(i), np.int64)
    words = words_at(raw)
    live = np.arange(len(i))
    rounds = 0
    while len(live) and rounds < 32:
        rounds += 1
        a, b = i[live] + length[live], j[live] + length[live]
        room = n - np.maximum(a, b)
        differ = words[np.minimum(a, n)] ^ words[np.minimum(b, n)]
        low = differ & (~differ + np.uint64(1))
        equal = np.where(differ == 0, 8, np.log2(np.maximum(low, 1).astype(np.float64)).astype(np.int64) // 8)
        step = np.minimum(equal, room)
        length[live] += step
        live = live[step == 8]
    for x in live.tolist():  # the few very long ones, in larger steps
        a, b, done = int(i[x]), int(j[x]), int(length[x])
        while True:
            size = min(4096, n - max(a, b) - done)
            differ = np.flatnonzero(raw[a + done : a + done + size] != raw[b + done : b + done + size])
            done += int(differ[0]) if len(differ) else size
            if len(differ) or size < 4096:
                break
        length[x] = done
    value = np.zeros(n, np.int64)
    value[i] = length
    last = np.maximum.accumulate(np.where(irreducible, at, 0))
    return np.maximum(value[last] - (at - last), 0)
