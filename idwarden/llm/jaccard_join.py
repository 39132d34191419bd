"""Set-similarity join of word shingles: groups of texts linked by a Jaccard similarity of 75 % or more.

A text's set is its distinct 5-word shingles (fewer words: all of them as one; A-Z lower-cased), as a sorted array of 64-bit
hashes. Equal sets are one node from the start, so copies cost one comparison in all.

1. ``profiles``: size, node (hash of the set) and bitmap signature of every text, and a count sketch of the shingles.
2. ``postings``: two sets that similar share one of the first quarter of their shingles, in any order that all texts share. The
   order is by the sketch, rare first, so a passage in a third of all texts comes last and forms no tile.
3. Tiles: nodes that share such a shingle, in bands of size within which sizes differ by a quarter. In a tile, first each node is
   compared with a few pivots alone (those of most of its tiles); then, once components are known, with one node of each larger component;
   at last all nodes of different components with each other. A tile of near copies thus costs as many comparisons as nodes, not as pairs, and no
   link between components is lost.
4. Each pair is held against its bounds: the shingles that can still follow the shared one, and, by bitmap, the bits in which
   the signatures differ (no fewer shingles differ; a bit is the parity of its shingles, and there are as many bits as shingles). Where nodes
   of a tile meet without a pivot, signatures folded to ``LEAST_BITS`` bits are there too, and only pairs within the bounds leave the tile.
   What is left is decided by exact intersection of the sorted arrays.
5. Components over the links (``components``).

NULL, empty and blank texts have an empty set and are linked with nothing. Repeated rows are one node. A NULL doc_id has a
component like any other; it names none unless all of its component are NULL. Nodes are told apart by 64 bits of hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idwarden.llm.arrays import Texts, Words, binaries, binary_values, join_hashes, mix, ranges, run_starts, starts_of, window_hashes
from idwarden.llm.components import components
from idwarden.llm.repeats import keyed
from idwarden.llm.store import save, shuffle_partitions, small, tidy

WORDS = 5
#: Bits of a signature, at least and at most; cells of the sketch, in blocks that are summed apart.
LEAST_BITS, MOST_BITS, CELLS, BLOCK = 512, 1 << 20, 1 << 18, 1 << 10
#: Pairs of a tile that are looked at together; pairs of one node that are intersected in one place.
PAIRS, PLACE_PAIRS = 1 << 20, 500
#: Pivots that a node is compared with in the first round; the second round misses none, whatever their number.
PIVOTS = 4
#: Leading bytes of the hashes of a set that travel to where it is intersected: two shingles of a pair share them once in 2 ** 48.
KEPT_BYTES = 6
U64 = np.uint64


def needed(a, b):
    """The least intersection of sets of these sizes with 100 * intersection >= 75 * union."""
    return -(-3 * (a + b) // 7)


def sets_of(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of all texts, sorted within each, and the number of each text."""
    words = Words(texts)
    hashes = words.hashes(lower=True)
    full = np.maximum(words.counts - WORDS + 1, 0)
    shingles = window_hashes(hashes, WORDS)[ranges(words.offsets[:-1], full)]
    rows = np.repeat(np.arange(len(texts)), full)
    for n in range(1, WORDS):
        short = np.flatnonzero(words.counts == n)
        shingles = np.append(shingles, window_hashes(hashes, n)[words.offsets[short]] if len(short) else shingles[:0])
        rows = np.append(rows, short)
    order = np.lexsort((shingles, rows))
    shingles, rows = shingles[order], rows[order]
    first = run_starts(rows, shingles)
    return shingles[first], np.bincount(rows[first], minlength=len(texts))


def nodes_of(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A hash of each set; 0 for empty ones."""
    out = np.zeros(len(counts), np.uint64)
    some = counts > 0
    at = starts_of(counts)[:-1][some]
    if len(at):
        out[some] = join_hashes(
            mix(np.add.reduceat(mix(shingles), at)) ^ counts[some].astype(U64), np.bitwise_xor.reduceat(mix(shingles * U64(0xD6E8FEB86659FD93)), at),
        ) | U64(1)
    return out.view(np.int64)


def signatures(shingles: np.ndarray, counts: np.ndarray) -> pa.Array:
    """For each set, the parity of its shingles in each of as many cells as it has shingles, or up to twice as many."""
    bits = 1 << np.ceil(np.log2(np.clip(counts, LEAST_BITS, MOST_BITS))).astype(np.int64)
    bits[counts == 0] = 0
    at = starts_of(bits)
    cell = np.repeat(at[:-1], counts) + (shingles & (np.repeat(bits, counts) - 1).astype(U64)).astype(np.int64)
    return binaries(np.packbits(np.bincount(cell, minlength=at[-1]).astype(np.uint8) & 1), at // 8)


def folds(shingles: np.ndarray, counts: np.ndarray) -> pa.Array:
    """For each set, its signature folded to ``LEAST_BITS`` bits."""
    cell = np.repeat(np.arange(len(counts)) * LEAST_BITS, counts) + (shingles & U64(LEAST_BITS - 1)).astype(np.int64)
    return binaries(np.packbits(np.bincount(cell, minlength=len(counts) * LEAST_BITS).astype(np.uint8) & 1), np.arange(len(counts) + 1) * (LEAST_BITS // 8))


def apart(x: bytes, y: bytes) -> int:
    """Bits in which signatures differ, the longer folded to the length of the shorter."""
    if len(x) > len(y):
        x, y = y, x
    x, y = np.frombuffer(x, np.uint8), np.bitwise_xor.reduce(np.frombuffer(y, np.uint8).reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def profiles(rows: DataFrame) -> DataFrame:
    """One row for each text (__id, __text, n, node, signature, fold), and each task's sketch in rows of (block, cells)."""
    names = ["__id", "__text", "n", "node", "signature", "fold", "block", "cells"]

    def run(batches):
        cells = np.zeros(CELLS, np.int64)
        for batch in batches:
            texts = Texts(batch.column("text"))
            for first, end in texts.slices():
                shingles, counts = sets_of(texts.piece(first, end))
                cells += np.bincount((shingles >> U64(40)).astype(np.int64) & (CELLS - 1), minlength=CELLS)
                size = end - first
                yield pa.RecordBatch.from_arrays([
                    batch.column("__id").slice(first, size), batch.column("__text").slice(first, size), pa.array(counts.astype(np.int32)),
                    pa.array(nodes_of(shingles, counts)), signatures(shingles, counts), folds(shingles, counts),
                    pa.nulls(size, pa.int32()), pa.nulls(size, pa.binary()),
                ], names=names)
        blocks = CELLS // BLOCK
        none = [pa.nulls(blocks, t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary())]
        if cells.any():
            yield pa.RecordBatch.from_arrays(
                [*none, pa.array(np.arange(blocks, dtype=np.int32)), binaries(cells, np.arange(blocks + 1) * BLOCK * 8)],
                names=names,
            )

    return rows.mapInArrow(tidy(run), "__id long, __text long, n int, node long, signature binary, fold binary, block int, cells binary")


def frequency_classes(sketch: DataFrame) -> np.ndarray:
    """For each cell 0 if its count may be chance, else a number that grows with it. CELLS bytes, whatever the corpus."""
    def total(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, cells in zip(batch.column("block").to_pylist(), batch.column("cells").to_pylist()):
                sums[block] = sums.get(block, 0) + np.frombuffer(cells, np.int64)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["block", "cells"],
            )

    parts = sketch.repartition(shuffle_partitions(sketch.sparkSession), "block").mapInArrow(tidy(total), "block int, cells binary").toArrow()
    cells = np.zeros(CELLS)
    for block, data in zip(parts.column("block").to_pylist(), parts.column("cells").to_pylist()):
        cells[block * BLOCK:(block + 1) * BLOCK] = np.frombuffer(data, np.int64)
    usual = np.median(cells) + 1
    heavy = cells > usual + 8 * np.sqrt(usual)
    return np.where(heavy, np.clip(1 + 4 * np.log2(cells / usual + 1), 1, 250), 0).astype(np.uint8)


def postings(rows: DataFrame, classes: np.ndarray) -> DataFrame:
    """token, node and size and place (packed in one number) of the first quarter of each set; of equal sets in a batch once."""
    def run(batches):
        for batch in batches:
            texts = Texts(batch.column("text"))
            seen = np.zeros(0, np.int64)
            for first, end in texts.slices():
                shingles, counts = sets_of(texts.piece(first, end))
                nodes = nodes_of(shingles, counts)
                _, at = np.unique(nodes, return_index=True)
                fresh = np.zeros(len(nodes), bool)
                fresh[at] = True
                fresh &= (counts > 0) & ~np.isin(nodes, seen)
                seen = np.append(seen, nodes[fresh])
                row = np.repeat(np.arange(len(counts)), counts)
                order = np.lexsort((shingles, classes[(shingles >> U64(40)).astype(np.int64) & (CELLS - 1)], row))
                begins, prefix = starts_of(counts)[:-1][fresh], (counts - -(-3 * counts // 4) + 1)[fresh]
                chosen = ranges(begins, prefix)
                place = chosen - np.repeat(begins, prefix)
                yield pa.RecordBatch.from_arrays([
                    pa.array(shingles[order][chosen].view(np.int64)), pa.array(np.repeat(nodes[fresh], prefix)),
                    pa.array(np.repeat(counts[fresh], prefix) << 32 | place),
                ], names=["token", "node", "at"])

    return rows.mapInArrow(tidy(run), "token long, node long, at long")


def _tiles(batches):
    """token, node, size and place of a partition's postings, sorted by token, size and node; repeats and lone tokens left out."""
    kept = [b for b in batches if b.num_rows]
    if not kept:
        return None
    token, node, at = (np.concatenate([b.column(c).to_numpy() for b in kept]) for c in ("token", "node", "at"))
    order = np.lexsort((node, at >> 32, token))
    token, node, at = token[order], node[order], at[order]
    first = run_starts(token, node, at >> 32)
    token, node, at, order = token[first], node[first], at[first], order[first]
    begins = run_starts(token)
    sizes = np.diff(np.append(begins, len(token)))
    many = np.repeat(sizes > 1, sizes)
    return token[many], node[many], at[many] >> 32, at[many] & 0xFFFFFFFF, kept, order[many]


def band_of(sizes: np.ndarray) -> np.ndarray:
    """Bands within which 4 * the smaller size >= 3 * the larger."""
    bounds, at = [1], 1
    top = int(sizes.max(initial=1))
    while at <= top:
        at = at * 4 // 3 + 1
        bounds.append(at)
    return np.searchsorted(np.array(bounds), sizes, "right")


def _possible(sizes, places, i, j):
    """Whether entries of one token may be similar, if it is the first that they share."""
    a, b = sizes[i], sizes[j]
    return (4 * np.minimum(a, b) >= 3 * np.maximum(a, b)) & (np.minimum(a - places[i], b - places[j]) >= needed(a, b))


def _pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each pair once, the smaller node first."""
    if not len(a):
        return a, b
    both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
    return both[0], both[1]


def star_pairs(shared: DataFrame) -> DataFrame:
    """Pairs of the pivot (smallest node) of a band in a tile and each of its other nodes, with the number of tiles; and the postings of
    tokens that nodes share (with a token)."""
    def run(batches):
        found = _tiles(batches)
        if found is None or not len(found[0]):
            return
        token, node, size, place, *_ = found
        band = band_of(size)
        order = np.lexsort((node, band, token))
        begins = run_starts(token[order], band[order])
        first = order[begins]
        # The pivot of the band below as well, so that groups of both bands become one.
        below = np.arange(len(begins)) - 1
        below = np.where((below >= 0) & (token[first[below]] == token[first]) & (band[first[below]] + 1 == band[first]), below, np.arange(len(begins)))
        mine, other = [], []
        for group in (np.arange(len(begins)), below):
            pivot = np.empty(len(token), np.int64)
            pivot[order] = np.repeat(first[group], np.diff(np.append(begins, len(order))))
            good = np.flatnonzero((node != node[pivot]) & _possible(size, place, np.arange(len(token)), pivot))
            mine.append(node[good])
            other.append(node[pivot[good]])
        (a, b), n = np.unique(np.stack([np.concatenate(other), np.concatenate(mine)]), axis=1, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(a), pa.int64()), pa.array(a), pa.array(b), pa.array(n)], names=["token", "a", "b", "n"])
        for at in range(0, len(token), 1 << 18):
            part = slice(at, at + (1 << 18))
            entries = [pa.array(token[part]), pa.array(node[part]), pa.array(size[part] << 32 | place[part])]
            yield pa.RecordBatch.from_arrays([*entries, pa.nulls(len(entries[0]), pa.int64())], names=["token", "a", "b", "n"])

    return shared.mapInArrow(tidy(run), "token long, a long, b long, n long")


def cross_pairs(shared: DataFrame, some: bool = False) -> DataFrame:
    """Pairs of nodes of different components in a tile; with ``some``, of each node and one node, by hash, of each larger component of
    several nodes. Only pairs that their folded signatures do not rule out. shared: token, node, at, component, fold."""
    def run(batches):
        found = _tiles(batches)
        if found is None or not len(found[0]):
            return
        token, node, size, place, kept, order = found
        group = np.concatenate([b.column("component").to_numpy() for b in kept])[order]
        fold = np.concatenate([binary_values(b.column("fold"), U64)[0] for b in kept]).reshape(-1, LEAST_BITS // 64)[order]
        # The largest component of a tile last: its nodes are compared with the others only.
        by = np.lexsort((group, token))
        begins = run_starts(token[by], group[by])
        sizes = np.diff(np.append(begins, len(by)))
        of_token = np.repeat(np.arange(len(run_starts(token))), np.diff(np.append(run_starts(token), len(token))))[by][begins]
        rank = np.lexsort((sizes, of_token))
        by = by[ranges(begins[rank], sizes[rank])]
        token, node, size, place, group, fold = token[by], node[by], size[by], place[by], group[by], fold[by]
        ends = np.searchsorted(token, token, "right")
        runs = run_starts(token, group)
        lengths = np.diff(np.append(runs, len(token)))
        after = np.repeat(np.append(runs[1:], len(token)), lengths)  # the next component
        if some:  # runs, not nodes: those after the node's own, of several nodes
            after = np.maximum(np.repeat(np.arange(1, len(runs) + 1), lengths), np.searchsorted(runs, _first_long(runs, lengths, token)))
            ends = np.searchsorted(runs, ends)
        counts = np.maximum(ends - after, 0)
        sums = starts_of(counts)
        at = 0
        while at < len(token):
            to = max(int(np.searchsorted(sums, sums[at] + PAIRS, "right")) - 1, at + 1)
            i, j = np.repeat(np.arange(at, to), counts[at:to]), ranges(after[at:to], counts[at:to])
            at = to
            if some:
                j = runs[j] + (mix(token[i].view(U64) ^ node[i].view(U64)) % lengths[j].astype(U64)).astype(np.int64)
            good = _possible(size, place, i, j)
            i, j = i[good], j[good]
            differ = np.zeros(len(i), np.int64)
            for word in fold.T:
                differ += np.bitwise_count(word[i] ^ word[j])
            good = (size[i] + size[j] - differ) // 2 >= needed(size[i], size[j])
            a, b = _pairs(node[i[good]], node[j[good]])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.ones(len(a), np.int64))], names=["a", "b", "n"])

    return shared.mapInArrow(tidy(run), "a long, b long, n long")


def _first_long(runs: np.ndarray, lengths: np.ndarray, token: np.ndarray) -> np.ndarray:
    """For each entry, where the first run of several entries begins in its tile (runs of a tile grow), or the tile's end."""
    tiles = run_starts(token)
    ends = np.append(tiles[1:], len(token))
    long = np.append(runs[lengths > 1], len(token))
    return np.repeat(np.minimum(long[np.searchsorted(long, tiles)], ends), ends - tiles)


def links(pairs: DataFrame, nodes: DataFrame, rows: DataFrame, best: bool = False) -> DataFrame:
    """The pairs (a, b) that are similar; with ``best``, of each b's pairs only those of most tiles (n) are looked at.

    nodes: node, n, signature and the row (__id, __text) that holds the set.
    """
    sides = [nodes.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("signature").alias(f"s_{s}")) for s in "ab"]
    both = pairs.groupBy("a", "b").agg(F.sum("n").alias("n")).join(sides[0], "a").join(sides[1], "b")

    def bounded(batches):
        for batch in batches:
            keep = [
                (n + m - apart(x, y)) // 2 >= needed(n, m)
                for n, m, x, y in zip(*(batch.column(c).to_pylist() for c in ("n_a", "n_b", "s_a", "s_b")))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b", "n")], names=["a", "b", "n"])

    left = save(both.mapInArrow(tidy(bounded), "a long, b long, n long"), "pairs")
    if best:
        ranked = left.groupBy("b").agg(F.slice(F.sort_array(F.collect_list(F.struct("n", "a")), asc=False), 1, PIVOTS).alias("best"))
        left = save(ranked.select(F.explode("best").alias("best"), "b").select("best.a", "b"), "pairs")
    # The sets of a's pairs meet at a; a busy a has several places, each with its set and a part of the others.
    places = left.groupBy("a").agg(F.ceil(F.count("*") / PLACE_PAIRS).alias("places"))
    others = left.join(small(save(places, "places")), "a").select(
        F.col("b").alias("node"), F.struct(F.col("a").alias("pivot"), F.pmod(F.xxhash64("b"), "places").alias("place"), F.lit(1).alias("role")).alias("at"))
    pivots = places.select(F.col("a").alias("node"), F.explode(F.sequence(F.lit(0), F.col("places") - 1)).alias("place")).select(
        "node", F.struct(F.col("node").alias("pivot"), "place", F.lit(0).alias("role")).alias("at"))
    wanted = others.unionByName(pivots).groupBy("node").agg(F.collect_list("at").alias("ats")).join(nodes, "node").select("node", "__id", "__text", "ats")
    wanted = small(save(wanted.withColumn("pivots", F.to_json("ats")).drop("ats"), "wanted"))

    def arrays(batches):
        for batch in batches:
            texts = Texts(batch.column("text"))
            for first, end in texts.slices():
                shingles, counts = sets_of(texts.piece(first, end))
                kept = np.ascontiguousarray(shingles.byteswap()).view(np.uint8).reshape(-1, 8)[:, :KEPT_BYTES]
                yield pa.RecordBatch.from_arrays([
                    batch.column("node").slice(first, end - first), batch.column("pivots").slice(first, end - first),
                    binaries(kept, KEPT_BYTES * starts_of(counts)),
                ], names=["node", "pivots", "tokens"])

    sets = rows.join(wanted, ["__id", "__text"]).mapInArrow(tidy(arrays), "node long, pivots string, tokens binary")
    sets = sets.withColumn("at", F.explode(F.from_json("pivots", "array<struct<pivot:long,place:long,role:int>>"))).select("at.*", "node", "tokens")
    meeting = sets.repartition(shuffle_partitions(rows.sparkSession), "pivot", "place").sortWithinPartitions("pivot", "place", "role")

    def intersect(batches):
        pivot = held = None
        for batch in batches:
            a, b = [], []
            for key, role, node, tokens in zip(*(batch.column(c).to_pylist() for c in ("pivot", "role", "node")), batch.column("tokens")):
                tokens = _numbers(tokens.as_buffer())
                if role == 0:
                    pivot, held = key, tokens
                elif _common(held, tokens) >= needed(len(held), len(tokens)):
                    a.append(pivot)
                    b.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return save(meeting.mapInArrow(tidy(intersect), "a long, b long"), "links")


def _numbers(tokens) -> np.ndarray:
    """Sorted integers from big-endian ones of ``KEPT_BYTES``."""
    kept = np.frombuffer(tokens, np.uint8).reshape(-1, KEPT_BYTES)
    out = np.zeros((len(kept), 8), np.uint8)
    out[:, 8 - KEPT_BYTES:] = kept
    return out.view(">u8").ravel().astype(U64)


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of sorted arrays without repeats."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    return int(np.count_nonzero(y[np.minimum(at, len(y) - 1)] == x)) if len(y) else 0


def groups(docs: DataFrame, with_component: bool = False) -> DataFrame:
    """doc_id, __text, n_shingles and component_id (and, if asked for, the component's node) of each row of ``docs`` (doc_id, text)."""
    rows = keyed(docs, "text")
    partitions = shuffle_partitions(docs.sparkSession)
    profile = save(profiles(rows), "profiles")
    classes = frequency_classes(profile.where("block IS NOT NULL").select("block", "cells"))
    texts = profile.where("block IS NULL")
    nodes = save(
        texts.where("n > 0").groupBy("node").agg(
            F.min(F.struct("__id", "__text")).alias("row"), F.first("n").alias("n"), F.first("signature").alias("signature"), F.first("fold").alias("fold"),
            F.min(F.when(F.col("__id") > -(2**63), F.col("__id"))).alias("least"),
        ).select("node", "n", "signature", "fold", "least", "row.*"), "nodes",
    )
    folded = small(nodes.select("node", "fold"))
    tiles = save(star_pairs(postings(rows, classes).repartition(partitions, "token")), "tiles")
    # A node is held against the pivots with which it shares most tiles; whatever that leaves apart is the second round's.
    first = links(tiles.where("token IS NULL").select("a", "b", "n"), nodes, rows, best=True)
    known = save(components(first), "components")
    shared = tiles.where("token IS NOT NULL").select("token", F.col("a").alias("node"), F.col("b").alias("at"))
    for some in (True, False):
        dealt = shared.join(small(known), "node", "left").join(folded, "node").select(
            "token", "node", "at", F.coalesce("component", "node").alias("component"), "fold")
        more = links(cross_pairs(dealt.repartition(partitions, "token"), some), nodes, rows)
        known = save(components(known.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)), "components")
    named = nodes.join(known, "node", "left").select("node", "least", F.coalesce("component", "node").alias("component"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = save(named.join(smallest, "component").select("node", "component", "component_id"), "names")
    doc_id = F.when(F.col("__id") > -(2**63), F.col("__id"))
    return texts.join(small(named), "node", "left").select(
        doc_id.alias("doc_id"), "__text", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(doc_id).alias("component_id"), *(["component"] if with_component else []),
    )


def labels(docs: DataFrame) -> DataFrame:
    return groups(docs).select("doc_id", "n_shingles", "component_id")
