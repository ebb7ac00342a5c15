"""Words of many texts at once: 64-bit word hashes by numpy, without a Python loop over words.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z lower-cased. Its hash is a
polynomial over random byte values modulo 2**64, mixed afterwards. Texts are taken as UTF-8, whole,
in blocks of about ``BLOCK_BYTES`` (a longer text is a block of its own).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

BLOCK_BYTES = 1 << 20

_rng = np.random.default_rng(20240229)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
CASED = _VALUES.copy()  # every byte has a value of its own
_VALUES[65:91] = _VALUES[97:123]  # A-Z hash as a-z
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def _grow(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        for name, base in (("_powers", _BASE), ("_inverses", _INVERSE)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            globals()[name] = np.multiply.accumulate(steps)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values; another salt gives another order."""
    x = (x ^ np.uint64(salt * 0xD1342543DE82EF95 & (1 << 64) - 1)) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def blocks(texts: Sequence[bytes], most: int = BLOCK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first text, texts) in blocks of bounded size."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > most:
            yield start, list(texts[start:i])
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, list(texts[start:])


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n or more powers of the base of the word hashes, and their inverses."""
    _grow(n)
    return _powers, _inverses


def word_hashes(texts: Sequence[bytes], space: np.ndarray = _SPACE, values: np.ndarray = _VALUES) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word of all texts in order, bounds): text i has words bounds[i]:bounds[i + 1].

    ``space`` marks the bytes between words (0x20 must be one); ``values`` is a value for each byte.
    """
    raw = np.frombuffer(b" ".join([b"", *texts, b""]), dtype=np.uint8)
    _grow(len(raw) + 1)
    gap = space[raw]
    edges = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    sums = values[raw]
    sums *= _powers[: len(raw)]
    np.cumsum(sums, out=sums)
    hashes = (sums[ends - 1] - sums[starts - 1]) * _inverses[starts]
    at = np.cumsum([1] + [len(t) + 1 for t in texts])
    return mix(hashes + (ends - starts).astype(np.uint64)), np.searchsorted(starts, at)


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each k-word shingle in order, bounds). A text of 1 to k-1 words has one: all its words."""
    n = np.diff(bounds)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    out_bounds = np.concatenate([[0], np.cumsum(count)])
    owner = np.repeat(np.arange(len(n)), count)
    at = bounds[owner] + np.arange(out_bounds[-1]) - out_bounds[owner]
    out = np.zeros(len(at), dtype=np.uint64)
    for j in range(k):
        here = at + j
        inside = here < bounds[owner + 1]
        step = mix(out + words[np.minimum(here, max(len(words) - 1, 0))], j + 1) if len(words) else out
        out = np.where(inside, step, out)
    return out, out_bounds


def distinct_by_text(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each text, ascending, and their bounds."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    first = np.ones(len(v), dtype=bool)
    first[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    counts = np.bincount(o[first], minlength=len(bounds) - 1)
    return v[first], np.concatenate([[0], np.cumsum(counts)])
