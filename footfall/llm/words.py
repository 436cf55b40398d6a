"""Words of a text and their hashes, for operators that work on Arrow batches.

Texts travel as UTF-8 bytes: every separator is ASCII, so bytes can be split
without being decoded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

# A to Z become a to z, everything else stays.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
# The same, and every ASCII character that is no letter or digit becomes a space.
LOWER_ALNUM = bytes(
    c if c >= 128 else (c | 32 if chr(c).isalpha() else c) if chr(c).isalnum() else 32 for c in range(256)
)
# Words remembered per Python worker; beyond that the memory starts afresh.
REMEMBERED = 200_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(32)


class Remembered(dict):
    """A bounded memory of a function's results."""

    def __init__(self, compute, most: int = REMEMBERED):
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.compute(key)
        return value


def texts_of(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The column's texts as bytes; a null is empty."""
    column = batch.column(batch.schema.get_field_index(name))
    if not pa.types.is_binary(column.type):
        column = column.cast(pa.binary())
    return [t or b"" for t in column.to_pylist()]


def word_hashes(words: list[bytes], memory: Remembered) -> np.ndarray:
    return np.fromiter(map(memory.__getitem__, words), np.uint64, len(words))


def hash_memory() -> Remembered:
    return Remembered(xxhash.xxh64_intdigest)


def mixed(h: np.ndarray) -> np.ndarray:
    h = h * _MIX
    return h ^ (h >> _SHIFT)


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for every run of ``k`` consecutive words."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h ^= hashes[i : i + n]
        h *= _MIX
        h ^= h >> _SHIFT
    return h


def run_lengths(flags: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, end) of every run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)


def array_of(type_: pa.DataType, offsets: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values).cast(pa.list_(type_))
