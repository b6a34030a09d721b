"""Word shingles of many texts at once, as 64-bit hashes, in numpy.

A text is lower-cased in A-Z and cut into words at ASCII white space; a shingle is a run of ``k`` words. A text with
fewer words has its whole sequence as one shingle; a text without words has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_P = np.uint64(0x5851F42D4C957F2D)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_MASK = (1 << 64) - 1
#: Bytes hashed at once: several short texts, or a part of a long one. What a text needs beside its set of shingles does
#: not grow with its length.
PART_BYTES = 1 << 18


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values() -> np.ndarray:
    """A 64-bit value for each byte, the same for a letter in either case."""
    values = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    values[65:91] = values[97:123]
    return values


def _power_table(base: np.uint64, n: int) -> np.ndarray:
    out, step = np.ones(1, np.uint64), base
    with np.errstate(over="ignore"):
        while len(out) < n:
            out = np.concatenate([out, out * step])
            step = step * step
    return out[:n]


_VALUES = _byte_values()
_UP, _DOWN = (_power_table(x, PART_BYTES + 1) for x in (_P, _P_INV))


def _runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of at most PART_BYTES bytes start and end, and each one's polynomial in its bytes. No word
    crosses an offset."""
    n = len(data)
    solid = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts = solid.copy()
    starts[1:] &= ~solid[:-1] | edge[1:n]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | edge[1:n]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUES[data] * _UP[:n], out=sums[1:])
    return s, e, (sums[e] - sums[s]) * _DOWN[s]


def _word_hashes(polynomials: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return _mix(polynomials + lengths.astype(np.uint64))


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and how many words each text has."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    s, e, p = _runs(data, offsets)
    return _word_hashes(p, e - s), np.diff(np.searchsorted(s, offsets))


def _words_in_parts(data: np.ndarray) -> Iterator[np.ndarray]:
    """The same hashes for one text of any length, part by part. A word that a part cuts goes on in the next."""
    open_p, open_n = np.zeros(1, np.uint64), 0
    for at in range(0, len(data), PART_BYTES):
        part = data[at : at + PART_BYTES]
        s, e, p = _runs(part, np.array([0, len(part)]))
        n = e - s
        if open_n:
            if len(s) and s[0] == 0:
                p[0] = open_p[0] + p[0] * np.uint64(pow(int(_P), open_n, 1 << 64))
                n[0] += open_n
            else:
                p, n, e = np.concatenate([open_p, p]), np.concatenate([[open_n], n]), np.concatenate([[0], e])
            open_n = 0
        if len(e) and e[-1] == len(part):
            open_p, open_n, p, n = p[-1:].copy(), int(n[-1]), p[:-1], n[:-1]
        yield _word_hashes(p, n)
    if open_n:
        yield _word_hashes(open_p, np.array([open_n]))


def _factors(k: int) -> np.ndarray:
    return _mix(np.arange(11, 11 + k, dtype=np.uint64)) | np.uint64(1)


def _shingles_of_words(h: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros(len(h) - k + 1, np.uint64)
    for j, f in enumerate(_factors(k)):
        out += h[j : len(out) + j] * f
    return out


def _few_words(h: np.ndarray, k: int) -> np.uint64:
    """The one shingle of fewer than k words."""
    return (h * _factors(k)[: len(h)]).sum(dtype=np.uint64) + np.uint64(len(h)) * np.uint64(0xD6E8FEB86659FD93)


def _long_set(data: np.ndarray, k: int) -> np.ndarray:
    """The sorted set of shingle hashes of one text. Parts are gathered until they are as many as the set so far."""
    found, new, fresh = np.zeros(0, np.uint64), [], 0
    tail = np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        for h in _words_in_parts(data):
            h = np.concatenate([tail, h])
            if len(h) >= k:
                new.append(_mix(_shingles_of_words(h, k)))
                fresh += len(new[-1])
            tail = h[max(0, len(h) - k + 1) :]
            if fresh > max(len(found), PART_BYTES):
                found, new, fresh = np.unique(np.concatenate([found, *new])), [], 0
        if not len(found) and not new and len(tail):
            return _mix(np.array([_few_words(tail, k)]))
    return np.unique(np.concatenate([found, *new]))


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of the texts ``data[offsets[i]:offsets[i+1]]``: all hashes in order (repeats included), and the
    bounds of each text's in them. At most PART_BYTES bytes."""
    with np.errstate(over="ignore"):
        h, words = _words(data, offsets)
        first = np.concatenate([[0], np.cumsum(words)])
        made = np.where(words >= k, words - k + 1, np.minimum(words, 1))
        bounds = np.concatenate([[0], np.cumsum(made)])
        out = np.zeros(bounds[-1], np.uint64)
        if len(h) >= k:
            runs = _shingles_of_words(h, k)
            text = np.repeat(np.arange(len(words)), made)
            place = np.arange(bounds[-1]) - bounds[text] + first[text]
            full = words[text] >= k
            out[full] = runs[place[full]]
        for i in np.flatnonzero((words > 0) & (words < k)):
            out[bounds[i]] = _few_words(h[first[i] : first[i + 1]], k)
        return _mix(out), bounds


def parts_of(offsets: np.ndarray) -> list[tuple[int, int]]:
    """Runs of texts of PART_BYTES at most; a longer text goes alone."""
    out, at = [], 0
    n = len(offsets) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PART_BYTES, side="right")) - 1)
        out.append((at, min(end, n)))
        at = min(end, n)
    return out


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int):
    """Yields the sorted set of shingle hashes of each text."""
    for lo, hi in parts_of(offsets):
        base = offsets[lo]
        if offsets[hi] - base > PART_BYTES:
            yield _long_set(data[base : offsets[hi]], k)
            continue
        hashes, bounds = shingle_hashes(data[base : offsets[hi]], offsets[lo : hi + 1] - base, k)
        for i in range(hi - lo):
            s = np.sort(hashes[bounds[i] : bounds[i + 1]])
            if len(s) > 1:
                s = s[np.concatenate([[True], s[1:] != s[:-1]])]
            yield s
