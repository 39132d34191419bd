"""Removal of byte strings that occur in an earlier text, by suffix arrays.

``repeats`` brings the candidate contexts of one anchor together. There, suffixes are sorted in two stages: those smaller
than their successor are sorted directly, seven bytes at a time; the others follow by scanning the buckets of first
bytes in order, each suffix placing its predecessor. Neighbours with a common prefix of a whole window are one
string; its smallest id keeps it.

NULL counts as empty; texts shorter than a window lose nothing. Strings are judged on the input, by doc_id; rows of equal id
do not cover each other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from idwarden.llm.arrays import Texts, binaries, binary_values, join_hashes, ranges, run_starts, starts_of
from idwarden.llm.repeats import Kind, covered_spans, keyed
from idwarden.llm.store import small, tidy

WINDOW, ANCHOR = 50, 24
#: Symbols (of 9 bits) that one sort key holds.
PACKED = 7


def two_stage_order(symbols: np.ndarray, wanted: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first ``depth`` symbols at least, and the packed symbols at each place.

    symbols: each text's symbols (from 1) and a final 0. wanted: places to sort; where a suffix is larger than its
    successor, the successor must be wanted too.
    """
    n = len(symbols)
    padded = np.append(symbols, np.zeros(PACKED, symbols.dtype)).astype(np.uint64)
    packed = np.zeros(n, np.uint64)
    open_ = np.ones(n, bool)
    for k in range(PACKED):
        now = np.where(open_, padded[k:k + n], 0)
        packed |= now << np.uint64(9 * (PACKED - 1 - k))
        open_ &= now != 0
    smaller = is_smaller(symbols)

    # First stage: the suffixes smaller than their successors, sorted directly.
    direct = np.flatnonzero(wanted & smaller)
    direct = direct[np.argsort(packed[direct], kind="stable")]
    same = np.zeros(len(direct), bool)
    same[1:] = packed[direct[1:]] == packed[direct[:-1]]
    for at in range(PACKED, depth, PACKED):
        group = np.cumsum(~same)
        tied = same.copy()
        tied[:-1] |= same[1:]
        places = np.flatnonzero(tied)
        if not len(places):
            break
        some, of = direct[places], group[places]
        key = _at(packed, symbols, some, at)
        order = np.lexsort((key, of))
        direct[places] = some[order]
        key = key[order]
        later = np.zeros(len(places), bool)
        later[1:] = (key[1:] == key[:-1]) & (of[1:] == of[:-1])
        same[places] = later

    # Second stage: each bucket, once complete, places the larger predecessors of its suffixes.
    waiting: dict[int, list[np.ndarray]] = {}
    heads = symbols[direct]
    bounds = np.searchsorted(heads, np.arange(int(symbols.max(initial=0)) + 2))
    out = []
    for c in range(int(symbols.max(initial=0)) + 1):
        parts = waiting.pop(c, [])
        new = np.concatenate(parts) if parts else direct[:0]
        parts = [new]
        while len(new):  # runs of c
            before = new[new > 0] - 1
            new = before[wanted[before] & (symbols[before] == c)]
            parts.append(new)
        bucket = np.concatenate([*parts, direct[bounds[c]:bounds[c + 1]]])
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[wanted[before] & (symbols[before] > c)]
        first = symbols[before]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        begins = run_starts(first)
        for a, b in zip(begins, np.append(begins[1:], len(first))):
            waiting.setdefault(int(first[a]), []).append(before[a:b])
    return (np.concatenate(out) if out else direct), packed


def is_smaller(symbols: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor. The final 0 of a text is."""
    begins = run_starts(symbols)
    heads = symbols[begins]
    rises = np.ones(len(begins), bool)
    rises[:-1] = heads[1:] > heads[:-1]
    rises[heads == 0] = True
    return np.repeat(rises, np.diff(np.append(begins, len(symbols))))


def _at(packed: np.ndarray, symbols: np.ndarray, places: np.ndarray, ahead: int) -> np.ndarray:
    """The packed symbols ``ahead`` of each place; 0 past the end of its text."""
    ended = _ended(symbols, places, ahead)
    return np.where(ended, np.uint64(0), packed[np.minimum(places + ahead, len(packed) - 1)])


def _ended(symbols: np.ndarray, places: np.ndarray, ahead: int) -> np.ndarray:
    zeros = starts_of(symbols == 0)
    return zeros[np.minimum(places + ahead, len(symbols))] > zeros[places]


def common_prefixes(symbols, packed, order, most: int) -> np.ndarray:
    """Symbols that each suffix shares with the one before it, as far as ``most`` (a multiple of 7)."""
    common = np.zeros(len(order), np.int64)
    alike = np.arange(1, len(order))
    zeros = starts_of(symbols == 0)
    for at in range(0, most, PACKED):
        a, b = order[alike - 1] + at, order[alike] + at
        inside = np.maximum(a, b) < len(packed)
        inside &= (zeros[np.minimum(a, len(symbols))] == zeros[a - at]) & (zeros[np.minimum(b, len(symbols))] == zeros[b - at])
        x = np.full(len(alike), np.uint64(2**63))
        x[inside] = packed[a[inside]] ^ packed[b[inside]]
        whole = x == 0
        rest, x = alike[~whole], x[~whole]
        for k in range(1, PACKED):
            common[rest] += (x >> np.uint64(9 * (PACKED - k))) == 0
        common[alike[whole]] += PACKED
        alike = alike[whole]
    return common


class Bytes(Kind):
    window, k = WINDOW, ANCHOR

    def units(self, texts: Texts):
        data = texts.data
        n = len(data)
        eight = np.zeros(max(n - 7, 0), np.uint64)
        for k in range(8):  # the eight bytes from each place on
            part = data[k:k + (n - k) // 8 * 8]
            eight[k::8][: len(part) // 8] = np.frombuffer(part.tobytes(), "<u8")
        hashes = join_hashes(join_hashes(eight[:-16], eight[8:-8]), eight[16:]) if n >= self.k else eight[:0]
        return texts.offsets, hashes, data

    def cut(self, state, starts, ends):
        lengths = ends - starts
        return binaries(state[ranges(starts, lengths)], starts_of(lengths))

    def holders(self, contexts, n_windows, ids):
        values, lengths = binary_values(contexts, np.uint8)
        places = starts_of(lengths + 1)
        symbols = np.zeros(places[-1], np.int64)
        symbols[ranges(places[:-1], lengths)] = values.astype(np.int64) + 1
        smaller = is_smaller(symbols)
        # Windows, and what follows them up to the next suffix that is sorted directly.
        following = np.minimum.accumulate(np.where(smaller, np.arange(len(symbols)), len(symbols))[::-1])[::-1]
        end = following[places[:-1] + n_windows - 1] + 1
        wanted = np.zeros(len(symbols), bool)
        wanted[ranges(places[:-1], end - places[:-1])] = True
        order, packed = two_stage_order(symbols, wanted, self.window)
        owner = np.full(len(symbols), -1)
        at = ranges(places[:-1], n_windows)
        owner[at] = np.repeat(np.arange(len(ids)), n_windows)
        order = order[owner[order] >= 0]
        common = common_prefixes(symbols, packed, order, -(-self.window // PACKED) * PACKED)
        begins = np.flatnonzero(common < self.window)
        least = np.minimum.reduceat(ids[owner[order]], begins)
        found = np.empty(len(symbols), np.int64)
        found[order] = np.repeat(least, np.diff(np.append(begins, len(order))))
        return found[at]


OUT = {"n_bytes": T.LongType(), "n_removed": T.LongType(), "n_spans": T.LongType(), "kept": T.BinaryType()}


def remove(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and the kept bytes of each row of ``docs`` (doc_id, text)."""
    found = small(covered_spans(docs, Bytes()))

    def run(batches):
        for batch in batches:
            texts = Texts(batch.column("text"))
            pairs, counts = binary_values(batch.column("marks"), "<i8")
            pairs, counts = pairs.reshape(-1, 2), starts_of(counts // 2)
            for first, end in texts.slices():
                piece = texts.piece(first, end)
                some = pairs[counts[first]:counts[end]]
                row = np.repeat(np.arange(end - first), np.diff(counts[first:end + 1]))
                keep = np.ones(len(piece.data), bool)
                keep[ranges(piece.offsets[row] + some[:, 0], some[:, 1] - some[:, 0])] = False
                sums = starts_of(keep)[piece.offsets]
                lengths = np.diff(piece.offsets)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(first, end - first), pa.array(lengths), pa.array(lengths - np.diff(sums)),
                    pa.array(np.diff(counts[first:end + 1])), binaries(piece.data[keep], sums),
                ], names=["doc_id", *OUT])

    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), *(T.StructField(k, v) for k, v in OUT.items())])
    return keyed(docs, "doc_id", "text").join(found, ["__id", "__text"], "left").select("doc_id", "text", "marks").mapInArrow(tidy(run), schema)


def digests(docs: DataFrame) -> DataFrame:
    return remove(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
