"""Words of a text as numpy arrays: places and 64-bit hashes, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U64 = np.uint64
#: Longest stretch of bytes that is hashed at once; bounds the memory a long text needs.
BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.int64).astype(U64)
_powers = [np.ones(1, U64), np.ones(1, U64)]

#: Deletes nothing, lower-cases A-Z and turns ASCII white space into a blank.
SPACES = b"\t\n\x0b\x0c\r "
LOWER = bytes(ord(chr(c).lower()) if 65 <= c <= 90 else 32 if c in SPACES else c for c in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (one-to-one)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _grow(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n + 1 of them."""
    if len(_powers[0]) <= n:
        size = max(n + 1, 4096)
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            step = np.full(size, base, U64)
            step[0] = 1
            _powers[i] = np.cumprod(step, dtype=U64)
    return _powers[0], _powers[1]


def spans(is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], is_word, [False])).view(np.int8)))
    return edge[::2], edge[1::2]


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span; spans are in order and do not overlap."""
    out = np.empty(len(starts), U64)
    at = 0
    while at < len(starts):
        base = starts[at]
        # as many spans as fit a block; one longer than a block goes alone
        to = max(at + 1, int(np.searchsorted(ends, base + BLOCK, "right")))
        a, b = starts[at:to] - base, ends[at:to] - base
        n = int(b[-1])
        power, inverse = _grow(n)
        total = np.zeros(n + 1, U64)
        np.cumsum(_BYTE_VALUES[codes[base : base + n]] * power[:n], out=total[1:])
        out[at:to] = mix((total[b] - total[a]) * inverse[a] + (b - a).astype(U64))
        at = to
    return out


def blank_words(data: bytes) -> np.ndarray:
    """Hashes of the words between ASCII white space, A-Z lower-cased."""
    codes = np.frombuffer(data.translate(LOWER), np.uint8)
    return span_hashes(codes, *spans(codes != 32))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of `size` words; fewer words make one shingle, no words none."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    total = np.full(n, size, U64)
    for j in range(size):
        total = mix(total + words[j : j + n])
    return total


def rows(batches: Iterator, *columns: str) -> Iterator[tuple]:
    """Python values of the columns of Arrow batches, row by row, a slice at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            yield from zip(*(part.column(c).to_pylist() for c in columns))
