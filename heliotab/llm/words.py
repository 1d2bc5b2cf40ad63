"""Word fingerprints and word shingles of whole texts, computed on Arrow buffers inside tasks.

A word is a maximal run of bytes other than ``0x20`` and ``0x09``-``0x0D`` after lower-casing
``A``-``Z``; its fingerprint is 64 bits of a polynomial over its bytes.  Everything here works on
one Arrow batch in blocks of about ``BLOCK_BYTES`` bytes, so memory does not follow the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19
SHINGLE_WORDS = 5

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PLACE = _rng.integers(1, 2**63, SHINGLE_WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_powers: tuple[np.ndarray, np.ndarray] | None = None


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse, modulo 2**64."""
    global _powers
    if _powers is None or len(_powers[0]) <= n:
        size = max(n + 1, BLOCK_BYTES + 2)
        step, back = np.full(size, _BASE), np.full(size, _BASE_INVERSE)
        step[0] = back[0] = 1
        _powers = np.cumprod(step, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits whose output bits all depend on all input bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def text_blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Pieces of an Arrow string array: first row, bytes, and offsets of its rows in these bytes.

    Nulls count as empty.  A text longer than ``limit`` makes a block of its own.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    start = 0
    while start < len(texts):
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), len(texts))
        yield start, data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start]
        start = end


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """``p`` such that bytes i..j have the hash ``(p[j] - p[i]) * inverse power i``."""
    step, _ = powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * step[: len(data)], out=total[1:])
    return total


def span_hash(total: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, back = powers(len(total))
    return mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64) * _BYTE[0])


def word_spans(
    data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words of a block, and offsets of the rows in the list of words."""
    inside = np.ones(len(data) + 2, bool)
    inside[0] = inside[-1] = False
    inside[1:-1] = ~separator[data]
    first, last = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    # Neighbouring rows touch in the buffer: a word never crosses a row's border.
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    both = inside[cuts] & inside[cuts + 1]
    first[cuts[both]] = True
    last[cuts[both] - 1] = True
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def shingle_stream(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the 5-word shingles of a block in text order, and the rows' offsets.

    A row of one to four words has its whole word sequence as its single shingle.
    """
    data = _LOWER[data]
    starts, ends, at = word_spans(data, offsets)
    words = span_hash(prefix_hash(data), starts, ends)
    counts = np.diff(at)
    n = len(words)
    acc = np.zeros(n, np.uint64)
    for i in range(min(SHINGLE_WORDS, n)):
        acc[: n - i] += words[i:] * _PLACE[i]
    size = np.where(counts >= SHINGLE_WORDS, counts - SHINGLE_WORDS + 1, (counts > 0).astype(np.int64))
    out = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=out[1:])
    take = np.arange(out[-1]) + np.repeat(at[:-1] - out[:-1], size)
    shingles = acc[take]
    for row in np.flatnonzero((counts > 0) & (counts < SHINGLE_WORDS)):
        own = words[at[row] : at[row + 1]]
        tagged = np.append(own * _PLACE[: len(own)], np.uint64(len(own) * 0x517CC1B727220A95 & (2**64 - 1)))
        shingles[out[row]] = tagged.sum(dtype=np.uint64)
    return mix(shingles), out


def distinct_sorted(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    if len(values) > 1:
        values = values[np.concatenate(([True], values[1:] != values[:-1]))]
    return values
