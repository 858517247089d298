"""Vectorised words and shingles over UTF-8 buffers.

A word is a maximal run of bytes outside ``\\x20 \\x09-\\x0D``, A-Z lower-cased. Words and shingles
are 64-bit hashes: a polynomial over substituted bytes, modulo 2**64, taken as a difference of running
sums, then mixed. Two different words of one pair of documents collide with a chance near 2**-64.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240501))
_BYTE = _rng.integers(1, 2**63, size=256, dtype=np.uint64) * U(2) + U(1)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
BYTE_LOWER = _BYTE[_LOWER]
BYTE_EXACT = _BYTE
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
_R = 0x9E3779B97F4A7C15 | 1
#: Bytes that are hashed at once; the tables of powers have this size, whatever the texts' lengths.
PIECE = 1 << 20
_TABLES: list[np.ndarray] = []
MULT = _rng.integers(1, 2**63, size=64, dtype=np.uint64) * U(2) + U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit hash."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def _powers() -> list[np.ndarray]:
    if not _TABLES:
        for base in (_R, pow(_R, -1, 2**64)):
            step = np.full(PIECE + 1, base, dtype=U)
            step[0] = 1
            _TABLES.append(np.cumprod(step, dtype=U))
    return _TABLES


def _polynomials(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lut: np.ndarray) -> np.ndarray:
    """Of each span of up to PIECE bytes in all: the sum of its bytes' values times powers of their places in the span."""
    power, inverse = _powers()
    sums = np.empty(len(raw) + 1, U)
    sums[0] = 0
    np.cumsum(lut[raw] * power[: len(raw)], out=sums[1:])
    return (sums[ends] - sums[starts]) * inverse[starts]


def span_hash(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lut: np.ndarray = BYTE_LOWER) -> np.ndarray:
    """Hashes of the byte spans [start, end) of ``raw``, which come in order. A span's hash is that of its bytes alone."""
    if len(raw) <= PIECE:
        found = _polynomials(raw, starts, ends, lut)
    else:
        found, i = np.empty(len(starts), U), 0
        while i < len(starts):
            a = int(starts[i])
            j = max(i + 1, int(np.searchsorted(ends, a + PIECE, side="right")))
            b = int(ends[j - 1])
            if b - a <= PIECE:
                found[i:j] = _polynomials(raw[a:b], starts[i:j] - a, ends[i:j] - a, lut)
            else:  # one long span, piece by piece
                total = 0
                for x in range(a, b, PIECE):
                    y = min(b, x + PIECE)
                    total += pow(_R, x - a, 2**64) * int(_polynomials(raw[x:y], np.array([0]), np.array([y - x]), lut)[0])
                found[i] = U(total % 2**64)
            i = j
    return mix(found + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


def word_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words in ``raw`` (texts at ``off``, from 0), and the number of words of each text."""
    n = len(raw)
    inside = ~SPACE[raw]
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    edge = off[:-1][off[:-1] < n]
    before[edge] = False
    tail = off[1:][off[1:] > 0] - 1
    after[tail] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    at = np.searchsorted(starts, off)
    return starts, ends, np.diff(at)


def words(raw: np.ndarray, off: np.ndarray, lut: np.ndarray = BYTE_LOWER):
    """Hash of every word, and the number of words of each text. ``off`` may start anywhere in ``raw``."""
    part, own = raw[off[0] : off[-1]], off - off[0]
    starts, ends, counts = word_spans(part, own)
    return span_hash(part, starts, ends, lut), counts


def shingles(h: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles in order, and their number for each text; a text of 1..k-1 words has its
    whole sequence as one shingle."""
    first = np.concatenate(([0], np.cumsum(counts)))
    n_sh = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    total = int(n_sh.sum())
    at = np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(n_sh)[:-1])), n_sh) + np.arange(total)
    size = np.repeat(np.minimum(counts, k), n_sh)
    padded = np.concatenate((h, np.zeros(k, U)))
    out = size.astype(U) * U(0xA24BAED4963EE407)
    full = bool((size == k).all())
    for j in range(k):
        term = padded[at + j] * MULT[j]
        out += term if full else np.where(j < size, term, U(0))
    return mix(out), n_sh


def distinct_sorted(v: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's values sorted, without repeats, and how many are left."""
    if not len(v):
        return v, counts
    edge = np.concatenate(([0], np.cumsum(counts)))
    v = v.copy()
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        if b - a > 1:
            v[a:b].sort()
    keep = np.ones(len(v), bool)
    keep[1:] = v[1:] != v[:-1]
    keep[edge[:-1][counts > 0]] = True
    kept = np.concatenate(([0], np.cumsum(keep)))
    return v[keep], kept[edge[1:]] - kept[edge[:-1]]


def sums(v: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each text's values modulo 2**64."""
    run = np.concatenate((np.zeros(1, U), np.cumsum(v, dtype=U)))
    edge = np.concatenate(([0], np.cumsum(counts)))
    return run[edge[1:]] - run[edge[:-1]]
