"""Removal of word sequences that occur in an earlier text, by FM-indexes.

``repeats`` brings the candidate contexts of one anchor together. Each shard of contexts gets an FM-index over its words: the
Burrows-Wheeler transform in a wavelet matrix of packed bits with a count for each 64. The contexts are then streamed
through it by backward search, all windows side by side, one word a step; the range of a window that matches over
its whole length is reported, and the smallest id in the range keeps the words. A window whose range has one suffix
left matches nothing but itself and is dropped from the search.

NULL text has no words; texts shorter than a window lose nothing. Windows are judged on the input, by doc_id; rows of equal
id do not cover each other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from idwarden.llm.arrays import Texts, Words, binaries, binary_values, ranges, starts_of, window_hashes, with_columns
from idwarden.llm.passing import packed, unpacked, widened
from idwarden.llm.repeats import PIECE_BYTES, Kind, covered_spans, keyed
from idwarden.llm.repetition import suffix_ranks
from idwarden.llm.store import small, tidy

WINDOW, ANCHOR = 50, 20


class BitVector:
    """Bits, packed, with the number of zeros before each 64."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros(-(-(n + 1) // 64) * 64, np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        ones = starts_of(np.bitwise_count(self.words))[:-1]
        self.zeros = np.arange(len(self.words)) * 64 - ones
        self.total = n - int(np.count_nonzero(bits))

    def zeros_before(self, at: np.ndarray) -> np.ndarray:
        block, inside = at >> 6, (at & 63).astype(np.uint64)
        mask = (np.uint64(1) << inside) - np.uint64(1)
        return self.zeros[block] + (at & 63) - np.bitwise_count(self.words[block] & mask)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for k in range(bits - 1, -1, -1):
            bit = (symbols >> k) & 1
            self.levels.append((k, BitVector(bit)))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def ranks(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each symbol occurs before ``low`` and before ``high``."""
        base = np.zeros(len(symbols), np.int64)
        for k, vector in self.levels:
            one = ((symbols >> k) & 1).astype(bool)
            moved = [vector.zeros_before(x) for x in (base, low, high)]
            base, low, high = (np.where(one, vector.total + x - z, z) for x, z in zip((base, low, high), moved))
        return low - base, high - base


class FMIndex:
    """Over sequences of symbols from 1 to ``size``: the ranges of suffixes that begin with a pattern."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, size: int):
        """symbols: the sequences, one after the other; lengths: of each."""
        places = starts_of(lengths + 1)
        text = np.zeros(places[-1], np.int64)
        self.owner = np.repeat(np.arange(len(lengths)), lengths + 1)
        text[ranges(places[:-1], lengths)] = symbols
        # The ends of sequences sort first, each apart from the others.
        keys = text + len(lengths)
        keys[places[1:] - 1] = np.arange(len(lengths))
        ranks = suffix_ranks(keys, np.full(len(text), len(text)))[-1]
        self.array = np.empty(len(text), np.int64)
        self.array[ranks] = np.arange(len(text))
        self.before = starts_of(np.bincount(text, minlength=size + 1))
        self.matrix = WaveletMatrix(text[self.array - 1], int(size).bit_length())
        self.text, self.places = text, places

    def extend(self, symbols, low, high):
        """The ranges of the patterns one symbol longer, to the left."""
        a, b = self.matrix.ranks(symbols, low, high)
        return self.before[symbols] + a, self.before[symbols] + b

    def windows(self, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of the ``n`` symbols at each place of the text: those with a range of several suffixes, and the range."""
        left = np.arange(len(starts))
        last = self.text[starts + n - 1]
        low, high = self.before[last], self.before[last + 1]
        for step in range(n - 2, -1, -1):
            several = high - low > 1
            if not several.all():
                left, low, high = left[several], low[several], high[several]
            low, high = self.extend(self.text[starts[left] + step], low, high)
        several = high - low > 1
        return left[several], low[several], high[several]


def range_minima(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The smallest value of each range, from minima over 1, 2, 4, ... values."""
    out = np.empty(len(low), values.dtype)
    level = np.frexp(high - low)[1] - 1
    width = 1
    for k in range(int(level.max(initial=-1)) + 1):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(values[low[at]], values[high[at] - width])
        values = np.minimum(values[: len(values) - width], values[width:])
        width *= 2
    return out


class WordUnits(Kind):
    window, k = WINDOW, ANCHOR

    def units(self, texts: Texts):
        words = Words(texts)
        return words.offsets, window_hashes(words.hashes(), self.k), words

    def cut(self, state: Words, starts, ends):
        lengths = state.ends - state.starts
        word = ranges(starts, ends - starts)
        size = lengths[word] + 1  # a space follows
        begin = starts_of(size)
        data = np.full(begin[-1], 32, np.uint8)
        data[ranges(begin[:-1], lengths[word])] = state.data[ranges(state.starts[word], lengths[word])]
        return binaries(data, begin[starts_of(ends - starts)])

    def holders(self, contexts, n_windows, ids):
        words = Words(Texts(contexts))
        _, symbols = np.unique(words.hashes(), return_inverse=True)
        index = FMIndex(symbols + 1, words.counts, int(symbols.max()) + 1)
        starts = ranges(index.places[:-1], n_windows)
        least = np.repeat(ids, n_windows)
        found, low, high = index.windows(starts, self.window)
        least[found] = range_minima(ids[index.owner[index.array]], low, high)
        return least


def spans_of(docs: DataFrame) -> DataFrame:
    """__id, __text and marks: the word ranges that ``docs`` (doc_id, text) loses."""
    return covered_spans(docs, WordUnits())


OUT = {"n_words": T.LongType(), "n_removed": T.LongType(), "kept": T.StringType()}


def remove(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, n_removed and ``kept``: the words left, joined by a space. Columns of these names are replaced."""
    found = small(spans_of(docs))
    plain = packed(docs, "doc_id", "text", without=tuple(OUT))
    schema = widened(plain, OUT)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        units = WordUnits()
        for batch in batches:
            texts = Texts(batch.column("text"))
            pairs, counts = binary_values(batch.column("marks"), "<i8")
            pairs, counts = pairs.reshape(-1, 2), starts_of(counts // 2)
            for first, end in texts.slices(PIECE_BYTES):
                words = Words(texts.piece(first, end))
                some = pairs[counts[first]:counts[end]]
                row = np.repeat(np.arange(end - first), np.diff(counts[first:end + 1]))
                keep = np.ones(len(words), bool)
                keep[ranges(words.offsets[row] + some[:, 0], some[:, 1] - some[:, 0])] = False
                sums = starts_of(keep)
                removed = words.counts - np.diff(sums[words.offsets])
                words.starts, words.ends = words.starts[keep], words.ends[keep]
                offsets = sums[words.offsets]
                kept = units.cut(words, offsets[:-1], offsets[1:]).to_pylist()
                yield with_columns(batch.slice(first, end - first), arrow, {
                    "n_words": pa.array(words.counts.astype(np.int64)), "n_removed": pa.array(removed.astype(np.int64)),
                    "kept": pa.array([k[:-1].decode() for k in kept], pa.string()),
                })

    rows = keyed(plain, *plain.columns).join(found, ["__id", "__text"], "left").select(*plain.columns, "marks")
    return unpacked(rows.mapInArrow(tidy(run), schema), docs, "doc_id", "text", new=tuple(OUT))


def digests(docs: DataFrame) -> DataFrame:
    return remove(docs.select("doc_id", "text")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
