"""Near-duplicate vectors against all pairs."""

import math

import numpy as np
from pyspark.sql import functions as F

from idwarden.llm import pstable_join

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, least=0.93):
    """[(vec_id, embedding, label)] -> sorted [(vec_id, n_links, component_id, kept)]; rows are vectors of their own."""
    def unit(v, label):
        if label is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, np.float32).astype(float)
        return v / np.linalg.norm(v)

    units = [unit(v, label) for _, v, label in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    n = [0] * len(rows)
    for i, (_, _, label) in enumerate(rows):
        for j in range(i):
            if units[i] is not None and units[j] is not None and label == rows[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= least:
                n[i] += 1
                n[j] += 1
                up[top(i)] = top(j)
    smallest = {}
    for i, (vec_id, _, _) in enumerate(rows):
        if vec_id is not None:
            smallest[top(i)] = min(smallest.get(top(i), vec_id), vec_id)
    found = [(r[0], n[i], smallest.get(top(i))) for i, r in enumerate(rows)]
    return sorted(((*r, r[0] == r[2]) for r in found), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)


def near(rng, v, cosine):
    """A vector at this cosine of v."""
    v = v / np.linalg.norm(v)
    w = rng.standard_normal(len(v))
    w -= (w @ v) * v
    return cosine * v + math.sqrt(1 - cosine * cosine) * w / np.linalg.norm(w)


def planted():
    rng = np.random.default_rng(3)
    rows, at = [], 0

    def add(v, label):
        nonlocal at
        at += 7
        rows.append((at, None if v is None else [float(np.float32(x)) if x is not None else None for x in v], label))

    for label in (0, 1):
        for _ in range(60):
            add(rng.standard_normal(24), label)
        centre = rng.standard_normal(24)
        for _ in range(70):
            add(near(rng, centre, rng.uniform(0.985, 1)), label)
        walk = rng.standard_normal(24)
        for _ in range(8):  # a chain: neighbours are linked, ends are not
            add(walk, label)
            walk = near(rng, walk, 0.96)
        for _ in range(15):
            add(centre, label)
        add(3 * centre, label)
    same = rows[0]
    add(same[1], 1)  # another label
    add(same[1], None)
    for bad in (None, [], [0.0] * 24, [float("nan")] * 24, [float("inf"), *[1.0] * 23], [None, *[1.0] * 23]):
        for _ in range(2):
            add(bad, 0)
    add(list(same[1][:12]), 0)
    add(list(same[1][:12]), 0)
    add([1e-30] * 24, 0)
    add([1e30] * 24, 0)
    rows += [same, same, (same[0], rows[30][1], 0), (None, rows[40][1], 0), (None, [1.0, *[0.0] * 23], 0)]
    return rows


def test_all_pairs(spark):
    rows = planted()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    df = df.withColumns({c: F.lit(5) for c in ("node", "n_links", "component", "component_id", "kept", "copies", "n", "a", "b", "size", "a.b")})
    assert got(pstable_join.near_copies(df)) == brute(rows)


def test_large_neighbourhoods_meet_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(pstable_join, "BLOCK_ROWS", 16)
    rows = planted()
    assert got(pstable_join.near_copies(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_recall_at_the_threshold(spark):
    """The hardest pairs, at a cosine just above the threshold, among vectors of one label."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(0, 1200, 2):
        v = rng.standard_normal(64)
        rows += [(i, v.tolist(), 0), (i + 1, near(rng, v, 0.9301).tolist(), 0)]
    found = got(pstable_join.near_copies(spark.createDataFrame(rows, SCHEMA)))
    linked = sum(n for _, n, *_ in found) / 1200
    assert linked >= 0.9 and all(n <= 1 for _, n, *_ in found)
    assert all(c == i - i % 2 for i, n, c, _ in found if n)


def test_chance_of_meeting():
    rng = np.random.default_rng(5)
    for distance in (0.2, 0.37, 1.4):
        apart = distance * rng.standard_normal(200_000)
        shift = rng.random(200_000) * pstable_join.WIDTH
        share = np.mean(np.floor(shift / pstable_join.WIDTH) == np.floor((shift + apart) / pstable_join.WIDTH))
        assert abs(share - pstable_join.meeting_chance(distance, pstable_join.WIDTH)) < 0.005


def test_no_bucket_is_shared(spark):
    rows = [(i, [float(j == i) for j in range(5)], 0) for i in range(5)]
    assert got(pstable_join.near_copies(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_no_rows(spark):
    assert got(pstable_join.near_copies(spark.createDataFrame([], SCHEMA))) == []
