"""Numpy kernels over many texts at once: bytes in one array, words, hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U64 = np.uint64
_rng = np.random.Generator(np.random.PCG64(20260101))
#: A random 64-bit value per byte value.
BYTE_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) << U64(1) | U64(1)
BASE = int(0x9E3779B97F4A7C15)
_INVERSE = pow(BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def _powers(kind: str, n: int) -> np.ndarray:
    """``BASE ** i`` (or of its inverse) modulo 2^64 for i < n, kept between calls."""
    held = _POWERS[kind]
    base = BASE if kind == "up" else _INVERSE
    while len(held) < n:
        held = np.concatenate([held, held * U64(pow(base, len(held), 1 << 64))])
    _POWERS[kind] = held
    return held[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> U64(31))
    x = x * U64(0x7FB5D329728EA185)
    x = x ^ (x >> U64(27))
    x = x * U64(0x81DADEF4BC2DD44D)
    return x ^ (x >> U64(33))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """n + 1 sums from which ``span_hashes`` takes the hash of any span."""
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(BYTE_VALUE[data] * _powers("up", len(data)), out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end): equal spans, equal hashes; the length counts."""
    down = _powers("down", len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + mix((end - start).astype(U64)))


def batches(texts: list[str | None], limit: int = 2 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bytes, ends) of runs of texts of about ``limit`` bytes in UTF-8.

    ``ends`` has one more entry than the run has texts and begins with 0.
    """
    at, held, size = 0, [], 0
    for k, text in enumerate(texts):
        raw = (text or "").encode()
        held.append(raw)
        size += len(raw)
        if size >= limit or k == len(texts) - 1:
            ends = np.zeros(len(held) + 1, np.int64)
            np.cumsum([len(x) for x in held], out=ends[1:])
            yield at, k + 1, np.frombuffer(b"".join(held), np.uint8), ends
            at, held, size = k + 1, [], 0


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of each word in order; A-Z lower-cased, words split at ASCII white space."""
    low = _LOWER[data]
    solid = ~_SPACE[data]
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    inner = ends[1:-1][ends[1:-1] < len(data)]
    begin[inner] = solid[inner]
    start = np.flatnonzero(begin)
    stop = solid.copy()
    stop[:-1] &= ~solid[1:]
    last = inner[inner > 0] - 1
    stop[last] = solid[last]
    end = np.flatnonzero(stop) + 1
    doc = np.searchsorted(ends, start, side="right") - 1
    return span_hashes(prefix_hashes(low), start, end), doc


def shingles(hashes: np.ndarray, doc: np.ndarray, n_docs: int, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (shingle hash, text number), ordered by text, then hash.

    A text with fewer than ``size`` words has one shingle, its whole word
    sequence; a text without words has none.
    """
    count = np.bincount(doc, minlength=n_docs)
    first = np.cumsum(count) - count
    long = count[doc] >= size
    position = np.arange(len(doc)) - first[doc]
    starts = np.flatnonzero(long & (position <= count[doc] - size))
    value = np.zeros(len(starts), U64)
    for k in range(size):
        value = mix(value * U64(BASE) + hashes[starts + k])
    owner = doc[starts]
    for d in np.flatnonzero((count > 0) & (count < size)):
        whole = np.zeros(1, U64)
        for k in range(first[d], first[d] + count[d]):
            whole = mix(whole * U64(BASE) + hashes[k : k + 1])
        # A short sequence is no prefix of a longer one's shingle: its length is mixed in.
        value = np.append(value, mix(whole + U64(count[d])))
        owner = np.append(owner, d)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], owner[new]
