"""Near-duplicate vectors of a label, by p-stable hashing for Euclidean distance and exact cosines.

On the unit sphere a cosine is a distance. A key of a table is ``HASHES`` random projections of the normalised vector, each shifted at
random and cut to steps of ``WIDTH``; close vectors share a key with a chance that ``tables_for`` works out, and there are as many tables as
take the recall at the threshold itself to ``RECALL`` (closer pairs are met more surely).

1. Equal vectors of a label are one node with a number of copies.
2. ``buckets``: each node goes to its key in each table with a sketch of 128 sign bits in place of its vector. Nodes of a chunk whose
   sketches differ from the first of their bucket by ``TIGHT`` bits at most are tied to it there, and only the first travels on; so a
   large group of near copies costs one entry a chunk and table. Whoever a tied node could meet, its first meets at ``TIGHT`` bits more
   (its slack).
3. In a bucket, nodes whose sketches may belong to linked vectors are tied; what leaves is a spanning forest, not pairs. Components
   over it (``components``) are neighbourhoods: no link that the tables found crosses them.
4. The vectors of a neighbourhood meet, in blocks of ``BLOCK_ROWS`` against each other if it is large. All its cosines are computed
   in double precision; each node sums the copies it is linked with, and the links leave as a spanning forest again. Work in a neighbourhood
   grows with its square, but rows, memory and shuffles do not.

Vectors that are NULL, empty or zero, or hold NULL or components that are not finite, and those without a label, are linked with nothing.
Vectors of different lengths are not compared. Repeated ids count as vectors of their own; a NULL id names a component only if all of it have none.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idwarden.llm.arrays import binaries, binary_values, mix, ranges, run_starts, starts_of
from idwarden.llm.components import components
from idwarden.llm.store import save, shuffle_partitions, small

LEAST_COSINE = 0.93
#: Projections of a key and the step they are cut to; pairs at the threshold that the tables meet.
HASHES, WIDTH, RECALL = 14, 2.0, 0.93
#: Bits of a sketch; standard deviations of its error beyond which a linked pair is missed; bits within which a chunk ties nodes.
BITS, DEVIATIONS, TIGHT = 128, 4.5, 6
CHUNK_ROWS, PAIRS, BLOCK_ROWS, PRODUCTS = 1 << 14, 1 << 20, 1 << 13, 1 << 21
SEED = 20240611
U64 = np.uint64


def meeting_chance(distance: float, width: float) -> float:
    """The chance that one projection of two points at this distance falls into one step (Datar et al., 2004)."""
    r = width / distance
    return math.erf(r / math.sqrt(2)) - math.sqrt(2 / math.pi) / r * (1 - math.exp(-r * r / 2))


def tables_for(cosine: float = LEAST_COSINE, hashes: int = HASHES, width: float = WIDTH, recall: float = RECALL) -> int:
    """Tables in which a pair at this cosine shares one key at least with a chance of ``recall``."""
    p = meeting_chance(math.sqrt(2 - 2 * cosine), width) ** hashes
    return math.ceil(math.log(1 - recall) / math.log(1 - p))


def far_bits(cosine: float) -> int:
    """Sketch bits in which a linked pair differs, at most, but for ``DEVIATIONS``."""
    share = math.acos(cosine) / math.pi
    return math.ceil(BITS * share + DEVIATIONS * math.sqrt(BITS * share * (1 - share)))


def vectors_of(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix of their unit vectors) for each length of usable vectors."""
    column = column.cast(pa.large_list(pa.float64()))
    offsets = column.offsets.to_numpy()
    lengths = np.diff(offsets)
    values = column.values.to_numpy(zero_copy_only=False)
    good = column.is_valid().to_numpy(zero_copy_only=False) & (lengths > 0)
    out = []
    for n in np.unique(lengths[good]):
        rows = np.flatnonzero(good & (lengths == n))
        found = values[offsets[rows][:, None] + np.arange(n)]  # NULL components read as NaN
        with np.errstate(all="ignore"):
            scale = np.abs(found).max(axis=1)
            usable = np.isfinite(scale) & (scale > 0)
            found, rows = found[usable] / scale[usable, None], rows[usable]
        out.append((rows, found / np.linalg.norm(found, axis=1)[:, None]))
    return out


def keys_and_sketches(unit: np.ndarray, tables: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit key for each vector and table, and two words of sign bits for each vector."""
    n = unit.shape[1]
    rng = np.random.default_rng([seed, n])
    steps = np.floor((unit @ rng.standard_normal((n, tables * HASHES)) + rng.random(tables * HASHES) * WIDTH) / WIDTH).astype(np.int64).view(U64)
    keys = np.zeros((len(unit), tables), U64) + mix(np.arange(tables, dtype=U64) + U64(n << 32))
    for k in range(HASHES):
        keys = mix(keys ^ mix(steps[:, k * tables:(k + 1) * tables]))
    signs = np.packbits(unit @ rng.standard_normal((n, BITS)) > 0, axis=1)
    return keys, np.ascontiguousarray(signs).view(U64)


def differing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(axis=1)


def joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each one's component, once a[i] and b[i] are in one. root: the same from before."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        root = root.copy()
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]


def nodes_of(vectors: DataFrame) -> DataFrame:
    """vec_id, label, embedding and node: a hash of label and vector, NULL for rows that are linked with nothing."""
    usable = F.col("label").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = usable & F.exists("embedding", lambda x: x != 0)
    return vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"),
    ).withColumn("node", F.when(usable, F.xxhash64("label", "embedding")))


def buckets(rows: DataFrame, partitions: int, cosine: float) -> DataFrame:
    """Entries of all tables, packed for each partition: bucket, keys, nodes, sketches, slacks; and ties (a, b) that chunks settle."""
    tables = tables_for(cosine)

    def packed(keys, nodes, sketches):
        # In each bucket of the chunk, those close to its first node are tied to it and stay.
        order = np.lexsort((nodes, keys))
        keys, nodes, sketches = keys[order], nodes[order], sketches[order]
        begins = run_starts(keys)
        first = np.repeat(begins, np.diff(np.append(begins, len(keys))))
        place = np.arange(len(keys))
        stays = (place != first) & (differing(sketches, sketches[first]) <= TIGHT)
        slacks = np.zeros(len(keys), np.uint8)
        slacks[first[stays]] = TIGHT
        a, b = nodes[first[stays]], nodes[stays]
        a, b = np.unique(np.stack([a, b])[:, a != b], axis=1) if len(a) else (a, b)
        # One tie is enough for each node of a component of the chunk.
        names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = joined(np.arange(len(names)), at[:len(a)], at[len(a):])
        tied = np.flatnonzero(root != np.arange(len(names)))
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(tied), pa.int32()), *(pa.nulls(len(tied), pa.binary()) for _ in range(4)), pa.array(names[tied]), pa.array(names[root[tied]])], names=columns)
        keys, nodes, sketches, slacks = keys[~stays], nodes[~stays], sketches[~stays], slacks[~stays]
        home = ((mix(keys) >> U64(32)) * U64(partitions) >> U64(32)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        parts = run_starts(home[order])
        ends = np.append(parts, len(order))
        yield pa.RecordBatch.from_arrays([
            pa.array(home[order][parts].astype(np.int32)), binaries(keys[order], 8 * ends), binaries(nodes[order], 8 * ends), binaries(sketches[order], 16 * ends),
            binaries(slacks[order], ends), pa.nulls(len(parts), pa.int64()), pa.nulls(len(parts), pa.int64()),
        ], names=columns)

    columns = ["bucket", "keys", "nodes", "sketches", "slacks", "a", "b"]

    def run(batches):
        held, size = [], 0
        for batch in batches:
            nodes = batch.column("node").to_numpy()
            labels = mix(batch.column("label_hash").to_numpy().view(U64))
            for rows_of, unit in vectors_of(batch.column("embedding")):
                _, fresh = np.unique(nodes[rows_of], return_index=True)
                rows_of, unit = rows_of[fresh], unit[fresh]
                keys, sketches = keys_and_sketches(unit, tables)
                keys = mix(keys ^ labels[rows_of][:, None])
                held.append((keys.ravel(), np.repeat(nodes[rows_of], tables), np.repeat(sketches, tables, axis=0)))
                size += len(rows_of)
            if size >= CHUNK_ROWS:
                yield from packed(*(np.concatenate(x) for x in zip(*held)))
                held, size = [], 0
        if held:
            yield from packed(*(np.concatenate(x) for x in zip(*held)))

    usable = rows.where("node IS NOT NULL").select("node", F.xxhash64("label").alias("label_hash"), "embedding")
    return usable.mapInArrow(run, "bucket int, keys binary, nodes binary, sketches binary, slacks binary, a long, b long")


def neighbours(entries: DataFrame, partitions: int, cosine: float) -> DataFrame:
    """Ties (a, b) of nodes of a bucket whose sketches may belong to linked vectors: a spanning forest for each task."""
    far = far_bits(cosine)

    def run(batches):
        kept = [b for b in batches if b.num_rows]
        if not kept:
            return
        kinds = (("keys", U64), ("nodes", np.int64), ("sketches", U64), ("slacks", np.uint8))
        keys, nodes, sketches, slacks = (np.concatenate([binary_values(b.column(c), kind)[0] for b in kept]) for c, kind in kinds)
        names, node = np.unique(nodes, return_inverse=True)
        sketches = sketches.reshape(-1, 2)
        order = np.lexsort((~slacks, node, keys))
        order = order[run_starts(keys[order], node[order])]
        keys, node, sketches, slacks = keys[order], node[order], sketches[order], slacks[order]
        begins = run_starts(keys)
        sizes = np.diff(np.append(begins, len(keys)))
        many = np.repeat(sizes > 1, sizes)
        if not many.any():
            return
        keys, node, sketches, slacks = keys[many], node[many], sketches[many], slacks[many]
        root = np.arange(len(names))
        for pivots in (True, False):
            # First with one node of each bucket alone, then all those that are still apart.
            order = np.lexsort((root[node], keys))
            keys, node, sketches, slacks = keys[order], node[order], sketches[order], slacks[order]
            ends = np.searchsorted(keys, keys, "right")
            runs = run_starts(keys, root[node])
            after = np.repeat(np.append(runs[1:], len(keys)), np.diff(np.append(runs, len(keys))))
            if pivots:
                after = np.arange(1, len(keys) + 1)
                ends = np.where(np.searchsorted(keys, keys) == np.arange(len(keys)), ends, after)
            counts = np.maximum(ends - after, 0)
            sums = starts_of(counts)
            at = 0
            while at < len(keys):
                to = max(int(np.searchsorted(sums, sums[at] + PAIRS, "right")) - 1, at + 1)
                i, j = np.repeat(np.arange(at, to), counts[at:to]), ranges(after[at:to], counts[at:to])
                at = to
                apart = root[node[i]] != root[node[j]]
                i, j = i[apart], j[apart]
                near = differing(sketches[i], sketches[j]) <= far + slacks[i].astype(np.int64) + slacks[j]
                root = joined(root, node[i[near]], node[j[near]])
        tied = np.flatnonzero(root != np.arange(len(names)))
        yield pa.RecordBatch.from_arrays([pa.array(names[tied]), pa.array(names[root[tied]])], names=["a", "b"])

    return entries.repartitionById(partitions, "bucket").mapInArrow(run, "a long, b long")


def links(members: DataFrame, partitions: int, cosine: float) -> DataFrame:
    """Rows (node, n, NULL): copies of other nodes that a node is linked with, in parts; and (node, NULL, other): a spanning forest of links.

    members: node, copies, embedding, component, size (nodes of the component).
    """
    blocks = F.ceil(F.col("size") / BLOCK_ROWS).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    cells = members.select("component", "node", "copies", "embedding", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")).select(
        "component", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "node", "copies", "embedding")
    dealt = cells.repartition(partitions, "component", "x", "y").sortWithinPartitions("component", "x", "y")

    def linked(held):
        table = pa.Table.from_batches(held).combine_chunks()
        own, node, copies = (table.column(c).to_numpy() for c in ("own", "node", "copies"))
        sides = table.column("x")[0].as_py(), table.column("y")[0].as_py()
        root = np.arange(len(node))
        sums = np.zeros(len(node), np.int64)
        for rows, unit in vectors_of(table.column("embedding").combine_chunks()):
            left = own[rows] == sides[0]
            a, b = rows[left], rows if sides[0] == sides[1] else rows[~left]
            left, right = unit[left], unit if sides[0] == sides[1] else unit[~left]
            step = max(PRODUCTS // max(len(b), 1), 1)
            for at in range(0, len(a), step):
                i, j = np.nonzero(left[at:at + step] @ right.T >= cosine)
                i, j = a[i + at], b[j]
                apart = i != j
                i, j = i[apart], j[apart]
                np.add.at(sums, i, copies[j])
                if sides[0] != sides[1]:
                    np.add.at(sums, j, copies[i])
                root = joined(root, i, j)
        some, tied = np.flatnonzero(sums), np.flatnonzero(root != np.arange(len(node)))
        return (node[some], sums[some]), (node[tied], node[root[tied]])

    def run(batches):
        held, of, ready = [], None, []
        size = 0

        def flush(force=False):
            nonlocal ready, size
            if ready and (force or size >= 1 << 16):
                sums, ties = ([np.concatenate(x) for x in zip(*part)] for part in zip(*ready))
                n, m = len(sums[0]), len(ties[0])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([sums[0], ties[0]])), pa.concat_arrays([pa.array(sums[1]), pa.nulls(m, pa.int64())]),
                    pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(ties[1])]),
                ], names=["node", "n", "other"])
                ready, size = [], 0

        for batch in batches:
            key = [batch.column(c).to_numpy() for c in ("component", "x", "y")]
            begins = run_starts(*key)
            for at, end in zip(begins, np.append(begins[1:], batch.num_rows)):
                cell = tuple(int(k[at]) for k in key)
                if held and cell != of:
                    ready.append(linked(held))
                    size += len(ready[-1][0][0])
                    held = []
                held.append(batch.slice(at, end - at))
                of = cell
            yield from flush()
        if held:
            ready.append(linked(held))
        yield from flush(True)

    return dealt.mapInArrow(run, "node long, n long, other long")


def near_copies(vectors: DataFrame, cosine: float = LEAST_COSINE) -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id (the smallest vec_id reachable) and kept (whether it is that one)."""
    partitions = shuffle_partitions(vectors.sparkSession)
    rows = nodes_of(vectors)
    nodes = save(rows.where("node IS NOT NULL").groupBy("node").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least")), "nodes")
    entries = save(buckets(rows, partitions, cosine), "buckets")
    ties = entries.where("bucket IS NULL").select("a", "b").unionByName(neighbours(entries.where("bucket IS NOT NULL").select("bucket", "keys", "nodes", "sketches", "slacks"), partitions, cosine))
    near = save(components(save(ties, "ties")).select("node", "component").distinct(), "neighbourhoods")
    sizes = near.groupBy("component").agg(F.count("*").alias("size"))
    named = small(save(near.join(small(save(sizes, "sizes")), "component").join(nodes.select("node", "copies"), "node"), "members"))
    members = rows.select("node", "embedding").join(named, "node").dropDuplicates(["node"])
    found = save(links(members, partitions, cosine), "links")
    tied = components(found.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")))
    tied = save(tied.select("node", "component").distinct(), "components")
    counted = found.where("n IS NOT NULL").groupBy("node").agg(F.sum("n").alias("n"))
    described = nodes.join(tied, "node", "left").join(counted, "node", "left").select(
        "node", "least", F.coalesce("component", "node").alias("component"), (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    smallest = described.groupBy("component").agg(F.min("least").alias("component_id"))
    described = small(save(described.join(smallest, "component").select("node", "n_links", "component_id").where("n_links > 0"), "described"))
    out = rows.select("vec_id", "node").join(described, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.when(F.col("n_links") > 0, F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))
