"""Where the windows of a text also start in a text of a smaller id: the work that both substring operators share.

A window is ``window`` consecutive units (bytes, or words) of one text. Its anchor is the place of the smallest hash of ``k``
units in it (the first, if tied), so equal windows have equal anchors at equal offsets, in whichever text they lie:

1. ``flagged``: anchors held by two ids or more. A task packs the anchors of a chunk of texts by range of hash; what two
   ids of a chunk share is settled there, and one entry of it leaves the chunk, so a passage in a third of all texts
   costs one entry a chunk. The ranges are matched in as many partitions as the session shuffles to.
2. ``contexts``: for flagged anchors only, the units that all windows of an anchor cover. Of equal contexts in a batch
   only those of the smallest id travel on; the others' windows are covered.
3. ``spans``: by anchor, an index over the distinct contexts finds the smallest id that holds each window. This step is the
   caller's (``Kind.holders``): a suffix array, or an FM-index.

Texts are read twice, and never grouped. Rows are told apart by id and hash of the text, so rows that repeat an id are kept
apart; equal ids never cover each other. A NULL id counts as smaller than all others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idwarden.llm.arrays import Texts, binaries, binary_values, fetch, mix, ranges, run_starts, sliding, starts_of
from idwarden.llm.store import save, shuffle_partitions, small, tidy

#: Windows taken at once within a long text; bytes of text taken at once; anchors per chunk; bytes of contexts indexed at once.
BLOCK, PIECE_BYTES, CHUNK_RUNS, INDEX_BYTES = 1 << 22, 1 << 18, 1 << 18, 1 << 19
_PLACE = np.uint64((1 << 24) - 1)
_NO_REPLY = 0xFFFFFFFF


class Kind:
    """What the units are. ``holders`` gets distinct contexts and an id for each; it returns, for all windows of all
    contexts in order, the smallest id of a context that holds an equal window."""

    window: int
    k: int

    def units(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, object]:
        """Offsets of texts into units, the hash of k units at each unit, and what ``cut`` needs."""
        raise NotImplementedError

    def cut(self, state, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The units of each range, as a binary column."""
        raise NotImplementedError

    def holders(self, contexts: pa.Array, n_windows: np.ndarray, ids: np.ndarray) -> np.ndarray:
        raise NotImplementedError


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """``docs`` with the row's key: __id and __text."""
    return docs.select(
        *columns, F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("__id"), F.xxhash64("text").alias("__text"),
    )


def runs_of(kind: Kind, offsets: np.ndarray, hashes: np.ndarray):
    """Runs of windows with one anchor: row, first window (unit), number of windows, hash of the anchor."""
    windows = np.maximum(np.diff(offsets) - kind.window + 1, 0)
    found = []
    if windows.sum():
        last = int((offsets[:-1] + windows).max())
        for block in range(0, last, BLOCK):
            some = hashes[block:block + BLOCK + kind.window - 1]
            packed = (some & ~_PLACE) | np.arange(len(some), dtype=np.uint64)
            width = kind.window - kind.k + 1
            if len(packed) < width:
                continue
            anchors = (sliding(np.minimum, packed, width) & _PLACE).astype(np.int64) + block
            low = np.clip(offsets[:-1], block, block + BLOCK)
            high = np.clip(offsets[:-1] + windows, block, block + BLOCK)
            counts = np.maximum(high - low, 0)
            starts = ranges(low, counts)
            rows = np.repeat(np.arange(len(counts)), counts)
            anchors = anchors[starts - block]
            at = run_starts(rows, anchors)
            found.append((rows[at], starts[at], np.diff(np.append(at, len(starts))), hashes[anchors[at]]))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


def ordinals(rows: np.ndarray, n: int) -> np.ndarray:
    """The place of each run within its row."""
    return np.arange(len(rows)) - starts_of(np.bincount(rows, minlength=n))[rows]


def flagged(docs: DataFrame, kind: Kind) -> DataFrame:
    """__id, __text and marks (pairs of uint32: first and end ordinal) of runs whose anchor two ids hold."""
    partitions = shuffle_partitions(docs.sparkSession)

    def pack(batches):
        chunk: list[tuple] = []
        size = base = 0

        def flush():
            if chunk:
                keys, row, order = (np.concatenate(x) for x in list(zip(*chunk))[2:5])
                ids, texts = (np.concatenate(x) for x in list(zip(*chunk))[:2])
                yield from packed_rows(ids, texts, keys, row, order, partitions)

        for batch in batches:
            all_texts = Texts(batch.column("text"))
            ids, marks = fetch(batch, "__id"), fetch(batch, "__text")
            for first, end in all_texts.slices(PIECE_BYTES):
                offsets, hashes, _ = kind.units(all_texts.piece(first, end))
                rows, _, _, keys = runs_of(kind, offsets, hashes)
                chunk.append((ids[first:end], marks[first:end], keys, rows + base, ordinals(rows, end - first)))
                base += end - first
                size += len(rows)
                if size >= CHUNK_RUNS:
                    yield from flush()
                    chunk, size, base = [], 0, 0
        yield from flush()

    def match(batches):
        kept = [b for b in batches if b.num_rows]
        if not kept:
            return
        table = pa.Table.from_batches(kept)
        done = table.filter(pc.is_null(table.column("keys"))).combine_chunks()
        found = [_entries(b)[1:] for b in done.to_batches()]
        rest = table.filter(pc.is_valid(table.column("keys"))).combine_chunks().to_batches()
        if rest:
            keys, ids, texts, order = (np.concatenate(x) for x in zip(*map(_entries, rest)))
            by = np.argsort(keys, kind="stable")
            begins = run_starts(keys[by])
            shared = np.minimum.reduceat(ids[by], begins) != np.maximum.reduceat(ids[by], begins)
            shared |= np.logical_or.reduceat(order[by] == _NO_REPLY, begins)  # such an entry stands for two ids
            held = np.empty(len(keys), bool)
            held[by] = np.repeat(shared, np.diff(np.append(begins, len(by))))
            held &= order != _NO_REPLY
            found.append((ids[held], texts[held], order[held]))
        ids, texts, order = (np.concatenate(x) for x in zip(*found))
        home = (mix(ids.view(np.uint64) ^ mix(texts.view(np.uint64))) % np.uint64(partitions)).astype(np.int64)
        yield blobs(home, ids, texts, order)

    def gather(batches):
        kept = [_entries(b)[1:] for b in batches if b.num_rows]
        if not kept:
            return
        ids, texts, order = (np.concatenate(x) for x in zip(*kept))
        by = np.lexsort((order, texts, ids))
        ids, texts, order = ids[by], texts[by], order[by].astype(np.int64)
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (texts[1:] != texts[:-1]) | (order[1:] > order[:-1] + 1)
        at = np.flatnonzero(new)
        pairs = np.stack([order[at], order[np.append(at[1:], len(ids)) - 1] + 1], axis=1).astype("<u4")
        ids, texts = ids[at], texts[at]
        rows = run_starts(ids, texts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[rows]), pa.array(texts[rows]), binaries(pairs, 8 * np.append(rows, len(ids)))], names=["__id", "__text", "marks"])

    kind_of = "bucket int, ids binary, texts binary, counts binary, orders binary, keys binary"
    matched = docs.mapInArrow(tidy(pack), kind_of).repartitionById(partitions, "bucket").mapInArrow(tidy(match), kind_of)
    return matched.repartitionById(partitions, "bucket").mapInArrow(tidy(gather), "__id long, __text long, marks binary")


def packed_rows(ids, texts, keys, row, order, partitions):
    """A chunk's anchors as one row for each range of hash, and rows of those that the chunk settles."""
    by = np.argsort(keys, kind="stable")
    keys, row, order = keys[by], row[by], order[by]
    begins = run_starts(keys)
    sizes = np.diff(np.append(begins, len(keys)))
    if not len(begins):
        return
    shared = np.minimum.reduceat(ids[row], begins) != np.maximum.reduceat(ids[row], begins)
    local = np.repeat(shared, sizes)
    sent = ~local
    sent[begins] = True
    # Anchors are small hashes: they are mixed again, so that all ranges are alike.
    bucket = ((mix(keys) >> np.uint64(32)) * np.uint64(partitions) >> np.uint64(32)).astype(np.int64)

    which = np.flatnonzero(sent)
    yield blobs(bucket[which], ids[row[which]], texts[row[which]], np.where(local[which], _NO_REPLY, order[which]), keys[which])
    which = np.flatnonzero(local)
    if len(which):
        yield blobs(bucket[which], ids[row[which]], texts[row[which]], order[which])


def blobs(bucket, ids, texts, order, keys=None) -> pa.RecordBatch:
    """Entries as one row for each bucket: its texts, the number of entries of each, and their ordinals and keys."""
    by = np.lexsort((order, texts, ids, bucket))
    bucket, ids, texts, order = bucket[by], ids[by], texts[by], order[by]
    docs = run_starts(bucket, ids, texts)
    counts = np.diff(np.append(docs, len(by))).astype("<u4")
    parts = run_starts(bucket[docs])
    ends = np.append(parts, len(docs))
    entry = np.append(docs, len(by))[ends]
    return pa.RecordBatch.from_arrays([
        pa.array(bucket[docs][parts].astype(np.int32)),
        binaries(ids[docs], 8 * ends), binaries(texts[docs], 8 * ends), binaries(counts, 4 * ends), binaries(order.astype("<u4"), 4 * entry),
        binaries(keys[by], 8 * entry) if keys is not None else pa.nulls(len(parts), pa.binary()),
    ], names=["bucket", "ids", "texts", "counts", "orders", "keys"])


def _entries(batch: pa.RecordBatch):
    """keys (or None), id, text hash and ordinal of each entry."""
    counts, _ = binary_values(batch.column("counts"), "<u4")
    ids, _ = binary_values(batch.column("ids"), np.int64)
    texts, _ = binary_values(batch.column("texts"), np.int64)
    order, _ = binary_values(batch.column("orders"), "<u4")
    keys = binary_values(batch.column("keys"), np.uint64)[0] if batch.column("keys").null_count < batch.num_rows else None
    return keys, np.repeat(ids, counts), np.repeat(texts, counts), order


def merged(rows: DataFrame) -> DataFrame:
    """One row for each __id and __text: all pairs (int64: first, end) of ``spans``, sorted and disjoint, in ``marks``."""
    def run(batches):
        for batch in batches:
            out = []
            for blobs_of in batch.column("parts").to_pylist():
                values = np.frombuffer(b"".join(blobs_of), "<i8")
                by = np.argsort(values[::2], kind="stable")
                first, end = values[::2][by], np.maximum.accumulate(values[1::2][by])
                new = np.ones(len(first), bool)
                new[1:] = first[1:] > end[:-1]
                at = np.flatnonzero(new)
                last = np.append(at[1:], len(first)) - 1
                out.append(np.stack([first[at], end[last]], axis=1).astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("__id"), batch.column("__text"), pa.array(out, pa.binary())], names=["__id", "__text", "marks"])

    return rows.groupBy("__id", "__text").agg(F.collect_list("spans").alias("parts")).mapInArrow(tidy(run), "__id long, __text long, marks binary")


def contexts(docs: DataFrame, marks: DataFrame, kind: Kind) -> DataFrame:
    """Contexts of flagged anchors; rows without a context are covered as they are."""
    def run(batches):
        for batch in batches:
            all_texts = Texts(batch.column("text"))
            ids, texts = fetch(batch, "__id"), fetch(batch, "__text")
            pairs, counts = binary_values(batch.column("marks"), "<u4")
            pairs, counts = pairs.astype(np.int64).reshape(-1, 2), starts_of(counts // 2)
            for first, end in all_texts.slices(PIECE_BYTES):
                offsets, hashes, state = kind.units(all_texts.piece(first, end))
                rows, starts, sizes, keys = runs_of(kind, offsets, hashes)
                runs = starts_of(np.bincount(rows, minlength=end - first))
                marked = pairs[counts[first]:counts[end]]
                owner = np.repeat(np.arange(end - first), np.diff(counts[first:end + 1]))
                chosen = ranges(runs[owner] + marked[:, 0], marked[:, 1] - marked[:, 0])
                if not len(chosen):
                    continue
                rows, starts, sizes, keys = rows[chosen], starts[chosen], sizes[chosen], keys[chosen]
                cut = kind.cut(state, starts, starts + sizes + kind.window - 1)
                code = pc.dictionary_encode(cut).indices.to_numpy(zero_copy_only=False)
                own = ids[first:end][rows]
                least = np.full(code.max() + 1, 2**63 - 1)
                np.minimum.at(least, code, own)
                covered = own > least[code]
                key = np.where(covered, texts[first:end][rows], keys.view(np.int64))
                yield pa.RecordBatch.from_arrays([
                    pa.array(key), pa.array(own), pa.array(texts[first:end][rows]),
                    pa.array(starts - offsets[rows]), pa.array(sizes.astype(np.int32)),
                    pc.if_else(pa.array(covered), pa.scalar(None, cut.type), cut),
                ], names=["key", "__id", "__text", "first", "n", "context"])

    return docs.join(small(marks), ["__id", "__text"]).mapInArrow(
        tidy(run), "key long, __id long, __text long, first long, n int, context binary")


def spans(found: DataFrame, kind: Kind) -> DataFrame:
    """__id, __text and marks: ranges of units that windows of a smaller id cover."""
    def run(batches):
        kept = [b for b in batches if b.num_rows]
        if not kept:
            return
        table = pa.Table.from_batches(kept)
        done = table.filter(pc.is_null(table.column("context"))).combine_chunks()
        ids, texts, first, n = (done.column(c).to_numpy() for c in ("__id", "__text", "first", "n"))
        yield from covers_of(ids, texts, first, first + n + kind.window - 1)
        table = table.filter(pc.is_valid(table.column("context"))).sort_by("key").combine_chunks()
        if not table.num_rows:
            return
        begins = np.append(run_starts(table.column("key").to_numpy()), table.num_rows)
        lengths = pc.binary_length(table.column("context")).to_numpy()
        sums = starts_of(lengths)
        at = 0
        while at < len(begins) - 1:
            to = int(np.searchsorted(sums[begins], sums[begins[at]] + INDEX_BYTES, "right")) - 1
            to = min(max(to, at + 1), len(begins) - 1)
            part = table.slice(begins[at], begins[to] - begins[at])
            at = to
            yield from covers_of(*covered_windows(part, kind))

    shuffled = found.repartition(shuffle_partitions(found.sparkSession), "key")
    return merged(shuffled.mapInArrow(tidy(run), "__id long, __text long, spans binary"))


def covered_windows(part: pa.Table, kind: Kind):
    """Row keys, and first and end unit, of the ranges that smaller ids cover."""
    ids, texts, first, n, keys = (part.column(c).to_numpy() for c in ("__id", "__text", "first", "n", "key"))
    coded = pc.dictionary_encode(part.column("context").combine_chunks())
    code = coded.indices.to_numpy(zero_copy_only=False)
    distinct = len(coded.dictionary)
    least = np.full(distinct, 2**63 - 1)
    np.minimum.at(least, code, ids)
    size, key = np.zeros(distinct, np.int64), np.zeros(distinct, np.int64)
    size[code], key[code] = n, keys
    # A context that is the only one of its anchor needs no index.
    _, group, members = np.unique(key, return_inverse=True, return_counts=True)
    several = members[group] > 1
    window = starts_of(size)
    holder = np.repeat(least, size)
    if several.any():
        chosen = np.flatnonzero(several)
        holder[ranges(window[chosen], size[chosen])] = kind.holders(coded.dictionary.take(pa.array(chosen)), size[chosen], least[chosen])
    # Runs of covered windows of each row.
    at = ranges(window[code], n.astype(np.int64))
    row = np.repeat(np.arange(len(code)), n)
    place = np.arange(len(at)) - starts_of(n.astype(np.int64))[row]
    hit = holder[at] < ids[row]
    row, place = row[hit], place[hit]
    if not len(row):
        return ids[:0], texts[:0], first[:0], first[:0]
    begins = run_starts(row, place - np.arange(len(place)))
    end = np.append(begins[1:], len(place)) - 1
    row = row[begins]
    return ids[row], texts[row], first[row] + place[begins], first[row] + place[end] + kind.window


def covers_of(ids, texts, first, end):
    if not len(ids):
        return
    by = np.lexsort((first, texts, ids))
    ids, texts = ids[by], texts[by]
    pairs = np.stack([first[by], end[by]], axis=1).astype("<i8")
    at = run_starts(ids, texts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(ids[at]), pa.array(texts[at]), binaries(pairs, 16 * np.append(at, len(ids)))], names=["__id", "__text", "spans"],
    )


def covered_spans(docs: DataFrame, kind: Kind) -> DataFrame:
    """__id, __text and marks (pairs of int64: first and end unit) of rows of ``docs`` (doc_id, text) that have any."""
    rows = keyed(docs, "text")
    marks = save(flagged(rows, kind), "anchors")
    return save(spans(contexts(rows, marks, kind), kind), "spans")
