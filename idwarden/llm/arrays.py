"""Texts of Arrow batches as numpy arrays: words, hashes, sliding windows. Used inside tasks only."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import as_strided

# Freed batches go back to the system, so that idle Python workers stay small.
pa.set_memory_pool(pa.system_memory_pool())

#: Bytes of text that are worked on at once; a longer text is worked on alone.
SLICE_BYTES = 1 << 20

#: White space that ends a word: 0x20 and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

U64 = np.uint64
_RNG = np.random.default_rng(20240607)
_A, _B, _C = (_RNG.integers(1, 2**63, 3, dtype=np.uint64) * U64(2) + U64(1)).tolist()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> U64(31))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(29))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(32))


def join_hashes(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hash of ordered pairs of hashes."""
    return mix(x * U64(_A) + (y ^ (y >> U64(30))) * U64(_B) + U64(_C))


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive elements of ``h``, by doubling; the last n - 1 elements start none."""
    if len(h) < n:
        return h[:0]
    k = 1
    while 2 * k <= n:
        h = join_hashes(h[: len(h) - k], h[k:])
        k *= 2
    return join_hashes(h[: len(h) - (n - k)], h[n - k:]) if n > k else h


def sliding(op, x: np.ndarray, n: int) -> np.ndarray:
    """``op`` (np.minimum or np.maximum) over each n consecutive elements."""
    k = 1
    while 2 * k <= n:
        x = op(x[: len(x) - k], x[k:])
        k *= 2
    return op(x[: len(x) - (n - k)], x[n - k:]) if n > k else x


def starts_of(counts: np.ndarray) -> np.ndarray:
    """Offsets of consecutive runs of these lengths, with the end."""
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... counts[0] of them, then those of the next, and so on."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    offsets = starts_of(counts)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - offsets[:-1], counts)


def run_starts(*keys: np.ndarray) -> np.ndarray:
    """Indexes at which a run of equal values of all ``keys`` begins."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


class Texts:
    """Rows of a string column as one byte array. NULL counts as empty."""

    def __init__(self, column: pa.Array):
        if column.null_count:
            column = pc.fill_null(column, "")
        wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
        offsets = np.frombuffer(column.buffers()[1] or bytes(8), np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
        data = column.buffers()[2]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.offsets = offsets - offsets[0]
        self.data = data[offsets[0]:offsets[-1]]

    def __len__(self):
        return len(self.offsets) - 1

    def slices(self, limit: int = SLICE_BYTES):
        """(first row, end row) of pieces of at most ``limit`` bytes, or of one row."""
        first, n = 0, len(self)
        while first < n:
            end = int(np.searchsorted(self.offsets, self.offsets[first] + limit, "right")) - 1
            end = min(max(end, first + 1), n)
            yield first, end
            first = end

    def piece(self, first: int, end: int) -> Texts:
        out = object.__new__(Texts)
        out.data = self.data[self.offsets[first]:self.offsets[end]]
        out.offsets = self.offsets[first:end + 1] - self.offsets[first]
        return out


class Words:
    """The words of texts: byte ranges, the row of each, and offsets of rows into the words."""

    def __init__(self, texts: Texts, space: np.ndarray = SPACE):
        self.split(texts, space[texts.data], texts.offsets)

    def split(self, texts: Texts, space: np.ndarray, borders: np.ndarray):
        """Words end at each byte of ``space``, and at ``borders``."""
        word = ~space
        before = np.ones(len(word), bool)
        before[1:] = space[:-1]
        inner = borders[(borders > 0) & (borders < len(word))]
        before[inner] = True
        self.data = texts.data
        self.starts = np.flatnonzero(word & before)
        after = np.ones(len(word), bool)
        after[:-1] = space[1:]
        after[inner - 1] = True
        self.ends = np.flatnonzero(word & after) + 1
        self.offsets = np.searchsorted(self.starts, texts.offsets)
        self.counts = np.diff(self.offsets)
        self.rows = np.repeat(np.arange(len(texts)), self.counts)

    def __len__(self):
        return len(self.starts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each word's bytes, with A-Z as a-z if ``lower``."""
        if not len(self):
            return np.zeros(0, np.uint64)
        lengths = self.ends - self.starts
        data = np.append(LOWER[self.data] if lower else self.data, np.zeros(8, np.uint8))
        eight = as_strided(data[:8].view(U64), (len(data) - 7,), (1,))  # the eight bytes from each place on
        counts = (lengths + 7) >> 3
        begin = starts_of(counts)[:-1]
        place = np.arange(counts.sum()) - np.repeat(begin, counts)
        block = eight[np.repeat(self.starts, counts) + 8 * place]
        # The last block of a word ends with it.
        rest = np.minimum(np.repeat(lengths, counts) - 8 * place, 8).astype(U64)
        block &= U64(0xFFFFFFFFFFFFFFFF) >> (U64(64) - U64(8) * rest)
        # A block counts by a mixed value of itself and its place, so that sums of other blocks do not agree by their form.
        value = mix(block ^ mix(place.astype(U64) * U64(_A) + U64(_B)))
        return mix(np.add.reduceat(value, begin) + lengths.astype(U64) * U64(_C))


def fetch(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """An integer column as int64 values; NULL as the smallest value."""
    return pc.fill_null(batch.column(name).cast(pa.int64()), -(2**63)).to_numpy(zero_copy_only=False)


def binaries(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column of consecutive byte ranges."""
    data = np.ascontiguousarray(data).view(np.uint8)
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def binary_values(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column of fixed-size values, and each row's number of values."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return np.frombuffer(data.tobytes(), kind), np.diff(offsets) // np.dtype(kind).itemsize


def with_columns(batch: pa.RecordBatch, schema: pa.Schema, new: dict[str, pa.Array]) -> pa.RecordBatch:
    """The columns of ``schema``, from ``new`` where it has them, else from the batch."""
    return pa.RecordBatch.from_arrays([new[f.name] if f.name in new else batch.column(f.name) for f in schema], schema=schema)
