"""Hashes of words and word shingles of whole Arrow batches, in numpy.

Small helpers for ``mapInArrow``. They work on the UTF-8 bytes of many texts at once, in
slices of bounded size, so that memory follows the longest text and not the batch.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Tasks get these functions by value: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE_BYTES = 2_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the published splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of rows; a null text has no bytes."""
    texts = texts.cast(pa.large_string()).fill_null("")
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1)
        end = min(end, len(texts))
        yield row, data[offsets[row]: offsets[end]], offsets[row: end + 1] - offsets[row]
        row = end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all rows in order, and each row's first word (with an end).

    Words lie between spaces and the control characters 9 to 13; A-Z count as a-z.
    """
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    inner = (data != 32) & ((data < 9) | (data > 13))
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inner[:-1]
    starts = np.flatnonzero(inner & (~before | first[:-1]))
    rows = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.empty(0, np.uint64), rows
    lengths = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, lengths)
    lower = data[starts[0]:].astype(np.uint64)
    lower += np.where((lower >= 65) & (lower <= 90), np.uint64(33), np.uint64(1))
    lower[~inner[starts[0]:]] = 0
    powers = np.cumprod(np.full(int(lengths.max()), _BASE, np.uint64))
    return mixed(np.add.reduceat(lower * powers[place], starts - starts[0])), rows


def shingle_sets(texts: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct hashes of its runs of n words) for each row in order.

    A row of fewer words has one shingle of all of them, a row without words none.
    """
    weights = mixed(np.arange(1, n + 1, dtype=np.uint64))
    for base, data, offsets in text_slices(texts):
        words, rows = word_hashes(data, offsets)
        runs = np.zeros(max(0, len(words) - n + 1), np.uint64)
        for k in range(n):
            runs += words[k: k + len(runs)] * weights[k]
        runs = mixed(runs)
        for row in range(len(offsets) - 1):
            a, b = rows[row], rows[row + 1]
            if b - a >= n:
                yield base + row, np.unique(runs[a: b - n + 1])
            else:
                whole = (words[a:b] * weights[: b - a]).sum(keepdims=True, dtype=np.uint64)
                yield base + row, mixed(whole + np.uint64(b - a)) if b > a else whole[:0]
