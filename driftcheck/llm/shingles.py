"""Word shingles of many texts at once, as 64-bit hashes in flat numpy arrays."""

from __future__ import annotations

import numpy as np

from driftcheck.llm.common import splitmix

WORDS = 5
CHUNK = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.isin(np.arange(256), [0x20, 9, 10, 11, 12, 13])
_TABLE = splitmix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_TABLE[65:91] = _TABLE[97:123]  # A-Z count as a-z
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64 and of its inverse."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, CHUNK + 4096)
        _POWERS[:] = [np.cumprod(np.r_[np.uint64(1), np.full(size - 1, p, np.uint64)]) for p in (_ODD, _ODD_INVERSE)]
    return _POWERS[0][:n], _POWERS[1][:n]


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word (a run of bytes that are no white space), A-Z lower-cased."""
    b = np.frombuffer(raw, np.uint8)
    if not len(b):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = np.r_[False, ~_SPACE[b], False]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    up, down = _powers(len(b) + 1)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_TABLE[b] * up[:-1], out=total[1:])
    return splitmix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64)), start


def _parts(docs: list[bytes]):
    """Runs of texts joined to about CHUNK bytes; a longer text is cut at white space into such parts."""
    held, size = [], 0
    for k, d in enumerate(docs):
        while len(d) > CHUNK:
            cut = max(d.rfind(c, CHUNK // 2, CHUNK) for c in (b" ", b"\n", b"\t"))
            if cut < 0:
                break
            if held:
                yield held
            yield [(k, d[:cut])]
            held, size, d = [], 0, d[cut:]
        if size + len(d) > CHUNK and held:
            yield held
            held, size = [], 0
        held.append((k, d))
        size += len(d) + 1
    if held:
        yield held


def words_of(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, flat, and the number of words of each."""
    out, n = [], np.zeros(len(docs), np.int64)
    for held in _parts(docs):
        h, start = word_hashes(b" ".join(d for _, d in held))
        at = np.cumsum([0, *(len(d) + 1 for _, d in held)])
        count = np.diff(np.searchsorted(start, at))
        np.add.at(n, [k for k, _ in held], count)
        out.append(h)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), n


def shingle_sets(docs: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, flat, with offsets.

    A text of fewer words has its whole sequence as one; one without words has none.
    """
    w, n = words_of(docs)
    if not len(docs):
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    first = np.cumsum(n) - n
    acc = np.zeros(len(w), np.uint64)
    for j in range(words):  # the shingle that starts at each word; ends that run over are dropped below
        acc *= _STEP
        acc[: max(0, len(w) - j)] += w[j:]
    counts = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    off = np.r_[0, np.cumsum(counts)]
    pos = np.arange(off[-1]) - np.repeat(off[:-1] - first, counts)
    h = splitmix(acc[pos])
    for k in np.flatnonzero((n > 0) & (n < words)):
        value = np.uint64(n[k])
        for x in w[first[k] : first[k] + n[k]]:
            value = np.uint64((int(value) * int(_STEP) + int(x)) & 0xFFFFFFFFFFFFFFFF)
        h[off[k]] = splitmix(np.array([value], np.uint64))[0]
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        h[a:b].sort()
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    new[off[:-1][counts > 0]] = True
    return h[new], np.r_[0, np.cumsum(new)][off]
