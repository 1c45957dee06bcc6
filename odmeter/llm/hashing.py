"""Word hashes of many texts at once, with array operations over their bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS = {b: np.ones(1, np.uint64) for b in (_BASE, _BASE_INVERSE)}

CHUNK_BYTES = 1 << 20
#: powers that a worker keeps, 20 MB of each base; those for longer buffers are made when they are asked for
KEEP_POWERS = 2_500_000


def powers(base: int, count: int) -> np.ndarray:
    """``base ** 0 .. base ** (count - 1)`` modulo 2^64."""
    held = _POWERS[base]
    if len(held) < count:
        factors = np.full(max(count, min(count + (count >> 1) + 1, KEEP_POWERS)), base, np.uint64)
        factors[0] = 1
        held = np.cumprod(factors)
        if len(held) <= KEEP_POWERS:
            _POWERS[base] = held
    return held[:count]


def mix64(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spreads 64-bit values; other salts give other, independent values."""
    x = x + np.uint64((salt * 0xD1B54A32D192ED03 + 0x8CB92BA72F3D8DD7) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Words of some texts: ``hashes`` in order, ``counts`` and ``bounds`` per text, ``starts`` and ``ends`` in ``data``."""

    def __init__(self, texts: list[bytes]):
        buffer = b"\n".join(texts) + b"\n"
        self.data = data = np.frombuffer(buffer, np.uint8)
        space = _SPACE[data]
        edge = np.diff(space.astype(np.int8), prepend=np.int8(1))
        self.starts, self.ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data + np.uint64(1)) * powers(_BASE, len(data)), out=sums[1:])
        scaled = (sums[self.ends] - sums[self.starts]) * powers(_BASE_INVERSE, len(data))[self.starts]
        self.hashes = mix64(scaled)
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        bounds = np.searchsorted(self.starts, np.concatenate([[0], np.cumsum(sizes)]))
        self.counts = np.diff(bounds)
        self.bounds = bounds
        self.doc = np.repeat(np.arange(len(texts)), self.counts)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``size`` words, and the text of each; a text with fewer words has one run of all of them."""
    hashes, doc = words.hashes, words.doc
    place = np.arange(len(hashes)) - np.repeat(words.bounds[:-1], words.counts)
    left = np.repeat(words.counts, words.counts) - place
    whole = (left >= size) | (place == 0)
    total = mix64(hashes, 1)
    for k in range(1, size):
        later = mix64(hashes[k:], k + 1)
        later[left[: len(later)] <= k] = 0
        total[: len(later)] += later
    return mix64(total[whole]), doc[whole]


def chunks(batches: Iterator[pa.RecordBatch], text: int, size: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with about ``size`` bytes of text each, and their texts; NULL is empty.  Only one slice's texts are copied."""
    for batch in batches:
        column = batch.column(text).cast(pa.binary())
        sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
        first, held = 0, 0
        for k, each in enumerate(sizes):
            held += each
            if held >= size or k == len(sizes) - 1:
                yield batch.slice(first, k + 1 - first), [t or b"" for t in column.slice(first, k + 1 - first).to_pylist()]
                first, held = k + 1, 0
