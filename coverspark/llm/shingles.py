"""Word shingles of whole texts as numbers."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: Bytes of words after lower-casing: digits, a-z and everything beyond ASCII.
_IS_WORD = np.array([48 <= k <= 57 or 97 <= k <= 122 or k >= 128 for k in range(256)])
_SEGMENT = 1 << 20


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, _SEGMENT * 2 + 1), _powers(_BACK, _SEGMENT * 2 + 1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (the finisher of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each word of at most two segments of bytes."""
    b = np.frombuffer(data, np.uint8)
    edge = np.diff(_IS_WORD[b].astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * _UP[: len(b)], out=total[1:])
    return start, mix((total[end] - total[start]) * _DOWN[start] + (end - start).astype(np.uint64))


def words_of(text: str) -> np.ndarray:
    """Hashes of the words of one text: runs of letters, digits and non-ASCII characters, lower-cased."""
    data = text.lower().encode("utf-8", "surrogatepass")
    if len(data) <= _SEGMENT:
        return _word_hashes(data)[1]
    out, at = [], 0
    while at < len(data):
        to = min(len(data), at + _SEGMENT)
        while to < len(data) and _IS_WORD[data[to]] and to - at < 2 * _SEGMENT:
            to += 1
        out.append(_word_hashes(data[at:to])[1])
        at = to
    return np.concatenate(out)


def shingles_of(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct shingles of `n` words; fewer words make one shingle, none make none."""
    if not len(words):
        return np.empty(0, np.uint64)
    n = min(n, len(words))
    h = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        h = (h + words[k : len(words) - n + 1 + k]) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return np.unique(mix(h + np.uint64(n)))


def texts_shingles(texts: list[str | None], n: int) -> list[np.ndarray]:
    """shingles_of for many texts; short texts share the passes over their bytes."""
    out: list[np.ndarray] = [np.empty(0, np.uint64)] * len(texts)
    group: list[int] = []
    size = 0
    for k, t in enumerate([*texts, None]):
        last = k == len(texts)
        if group and (last or size + 4 * len(t or "") > _SEGMENT):
            parts = [texts[g].lower().encode("utf-8", "surrogatepass") for g in group]
            ends = np.cumsum([len(p) + 1 for p in parts])
            start, words = _word_hashes(b"\n".join(parts))
            at = np.searchsorted(start, np.r_[0, ends])
            for g, a, b in zip(group, at, at[1:]):
                out[g] = shingles_of(words[a:b], n)
            group, size = [], 0
        if last or not t:
            continue
        if 4 * len(t) > _SEGMENT:
            out[k] = shingles_of(words_of(t), n)
        else:
            group.append(k)
            size += 4 * len(t) + 1
    return out
