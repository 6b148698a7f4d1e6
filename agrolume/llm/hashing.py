"""Word and shingle hashes of many texts at once, as numpy arrays of 64-bit integers.

A word's hash is a polynomial over its bytes, taken from running sums over the
whole block of texts, then mixed; a shingle's hash folds its words' hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes hashed together: bounds the arrays of one step (a longer text is a step of its own).
BLOCK = 2_000_000

_ODD = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)
_BYTES = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, BLOCK + 1)
        for k, base in enumerate((_ODD, pow(_ODD, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of all texts in order, number of words before each text and at the end).

    Words are runs without space, tab, line feed, vertical tab, form feed and carriage return.
    """
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    before = np.concatenate(([True], blank[:-1]))
    starts = np.flatnonzero(before & ~blank)
    ends = np.flatnonzero(~before & blank)
    power, inverse = _tables(len(data))
    sums = np.cumsum(_BYTES[data] * power[: len(data)])
    hashes = mix((sums[ends - 1] - np.where(starts > 0, sums[starts - 1], np.uint64(0))) * inverse[starts])
    edges = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    return hashes, np.searchsorted(starts, edges)


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles of one text; with fewer words, of the whole sequence as one."""
    n = len(hashes)
    if n == 0:
        return hashes
    k = min(k, n)
    out = hashes[: n - k + 1].copy()
    for j in range(1, k):
        out = mix(out * _STEP + hashes[j : n - k + 1 + j])
    return out


def blocks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about BLOCK bytes."""
    first = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BLOCK:
            yield first, i
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield first, len(texts)


def word_arrays(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The word hashes of each text, in order."""
    for a, b in blocks(texts):
        hashes, edges = words(texts[a:b])
        for i in range(b - a):
            yield hashes[edges[i] : edges[i + 1]]


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts hold some megabytes, so that what is made of them stays small."""
    first = size = 0
    for i, n in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
        size += (n or 0) + 1
        if size >= 2 * BLOCK:
            yield batch.slice(first, i + 1 - first)
            first, size = i + 1, 0
    if first < batch.num_rows:
        yield batch.slice(first)
