"""The time operators against brute force, with few chunks, many chunks and one busy key."""

import random

import pytest
from support import START, at, rows
from pyspark.sql import functions as F

from idwarden.operators.keyed import without_match
from idwarden.operators.temporal import (
    asof_join,
    asof_scan,
    band_join,
    count_pairs_before,
    joined_runs,
    run_parts,
    with_previous,
    without_band_match,
)

SPAN = 20_000


def events(seed, n, users=("a", "a", "a", "b", "c", None)):
    """Half of the rows or more belong to one user; some have no time; times collide."""
    rnd = random.Random(seed)
    return [
        (rnd.choice(users), None if rnd.random() < 0.05 else rnd.randrange(0, SPAN * 4) / 4, f"{seed}-{i:03d}")
        for i in range(n)
    ]


def frame(spark, data, prefix):
    typed = [(u, None if s is None else at(s), i) for u, s, i in data]
    return spark.createDataFrame(typed, f"user string, {prefix}_ts timestamp_ntz, {prefix}_id string")


def whole(s):
    return int(s // 1)


@pytest.fixture(scope="module")
def sides(spark):
    left, right = events(1, 160), events(2, 140)
    return left, right, frame(spark, left, "l").cache(), frame(spark, right, "r").cache()


@pytest.mark.parametrize("lo,hi", [(0, 3600), (1, 600), (-700, 700), (0, 0), (-50_000, 50_000)])
def test_band_join(sides, lo, hi):
    left, right, l_df, r_df = sides
    got = rows(band_join(l_df, r_df, ["user"], "l_ts", "r_ts", lo, hi), "l_id", "r_id")
    want = sorted(
        (li, ri) for lu, ls, li in left for ru, rs, ri in right
        if lu is not None and lu == ru and None not in (ls, rs) and lo <= whole(rs) - whole(ls) <= hi
    )
    assert got == want


@pytest.mark.parametrize("lo,hi", [(0, 3600), (-700, 700), (-50_000, 50_000)])
def test_without_band_match(sides, lo, hi):
    left, right, l_df, r_df = sides
    got = rows(without_band_match(l_df, r_df, ["user"], "l_ts", "r_ts", lo, hi), "l_id")
    want = sorted(
        (li,) for lu, ls, li in left
        if not any(
            lu is not None and lu == ru and None not in (ls, rs) and lo <= whole(rs) - whole(ls) <= hi
            for ru, rs, _ in right
        )
    )
    assert got == want


@pytest.mark.parametrize("chunk_sec", [100, 3600, 10**6])
@pytest.mark.parametrize("within_sec", [None, 90, 5000])
@pytest.mark.parametrize("forward,strict,whole_seconds", [
    (False, False, False), (False, True, False), (True, False, True), (True, True, True), (False, True, True),
])
def test_asof_join(sides, chunk_sec, within_sec, forward, strict, whole_seconds):
    left, right, l_df, r_df = sides
    found = asof_join(
        l_df, r_df, ["user"], "l_ts", "r_ts", "r_id", forward=forward, strict=strict, whole_seconds=whole_seconds,
        within_sec=within_sec, how="left", chunk_sec=chunk_sec,
    )
    got = dict(rows(found, "l_id", "match.r_id"))
    cut = whole if whole_seconds else (lambda s: s)
    for lu, ls, li in left:
        fits = []
        for ru, rs, ri in right:
            if lu is None or lu != ru or ls is None or rs is None:
                continue
            gap = cut(rs) - cut(ls) if forward else cut(ls) - cut(rs)
            if gap > 0 or (gap == 0 and not strict):
                fits.append((rs, ri))
        best = (min(fits) if forward else max(fits)) if fits else None
        if best and within_sec is not None and abs(whole(best[0]) - whole(ls)) > within_sec:
            best = None
        assert got[li] == (best[1] if best else None)
    assert len(got) == len(left)


def test_asof_join_with_copies(sides):
    """Copies on either side change neither the matches nor, on the right, the number of rows."""
    _, _, l_df, r_df = sides
    once = rows(asof_join(l_df, r_df, ["user"], "l_ts", "r_ts", "r_id"), "l_id", "match.r_id")
    twice = asof_join(l_df.unionByName(l_df), r_df.unionByName(r_df), ["user"], "l_ts", "r_ts", "r_id")
    assert rows(twice, "l_id", "match.r_id") == sorted(once * 2, key=repr)


@pytest.mark.parametrize("within_sec", [None, 90, 5000])
@pytest.mark.parametrize("forward", [False, True])
def test_asof_scan_with_several_targets(sides, within_sec, forward):
    """One pass finds for each time what a join for each target would, and the smallest left row of each kind."""
    _, _, l_df, r_df = sides
    kinds = {"any_row": F.lit(True), "even": F.substring("r_id", 5, 1).cast("int") % 2 == 0, "none": F.lit(False)}
    steps = dict(forward=forward, whole_seconds=True, within_sec=within_sec, chunk_sec=3600)
    odd = F.when(F.substring("l_id", 5, 1).cast("int") % 2 == 1, F.col("l_id"))
    found = asof_scan(l_df, r_df, ["user"], "l_ts", "r_ts", "r_id", kinds, keep={"first_id": F.col("l_id"), "odd_id": odd}, **steps)
    times = l_df.where("user IS NOT NULL AND l_ts IS NOT NULL").groupBy("user", "l_ts")
    assert rows(found, "user", "l_ts", "first_id", "odd_id") == rows(times.agg(F.min("l_id").alias("first_id"), F.min(odd).alias("odd_id")))
    for kind, wanted in kinds.items():
        single = asof_join(times.agg(F.count("*")), r_df.where(wanted), ["user"], "l_ts", "r_ts", "r_id", how="left", **steps)
        assert rows(found, "user", "l_ts", f"{kind}.r_id") == rows(single, "user", "l_ts", "match.r_id")


def test_asof_join_inner_drops_unmatched(sides):
    _, _, l_df, r_df = sides
    inner = asof_join(l_df, r_df, ["user"], "l_ts", "r_ts", "r_id")
    outer = asof_join(l_df, r_df, ["user"], "l_ts", "r_ts", "r_id", how="left")
    assert rows(inner, "l_id") == rows(outer.where("match is not null"), "l_id")


@pytest.mark.parametrize("chunk_sec", [100, 3600, 10**6])
def test_with_previous(sides, chunk_sec):
    left, _, l_df, _ = sides
    got = dict(rows(with_previous(l_df, ["user"], "l_ts", "l_id", ["l_id"], chunk_sec=chunk_sec), "l_id", "prev.l_id"))
    ordered = sorted((u, s, i) for u, s, i in left if u is not None and s is not None)
    want = {}
    for before, here in zip([None, *ordered], ordered):
        want[here[2]] = before[2] if before and before[0] == here[0] else None
    assert got == want


@pytest.mark.parametrize("chunk_sec", [100, 3600])
def test_with_previous_bounded(sides, chunk_sec):
    _, _, l_df, _ = sides
    def near(df):
        gap = F.unix_timestamp("l_ts") - F.unix_timestamp("prev.l_ts")
        return rows(df.where(gap <= 100), "l_id", "prev.l_id")
    carry = ["l_id", "l_ts"]
    full = with_previous(l_df, ["user"], "l_ts", "l_id", carry, chunk_sec=chunk_sec)
    bounded = with_previous(l_df, ["user"], "l_ts", "l_id", carry, chunk_sec=chunk_sec, within_sec=100)
    assert near(full) == near(bounded)


@pytest.mark.parametrize("chunk_sec", [100, 3600, 10**6])
def test_count_pairs_before(sides, chunk_sec):
    left, right, l_df, r_df = sides
    got = count_pairs_before(l_df, r_df, ["user"], F.col("l_ts"), F.col("r_ts"), chunk_sec=chunk_sec).collect()[0].n
    want = sum(
        1 for lu, ls, _ in left for ru, rs, _ in right
        if lu is not None and lu == ru and None not in (ls, rs) and rs < ls
    )
    assert got == want > 0


@pytest.mark.parametrize("gap_sec", [1, 7, 100, 5000])
def test_runs_from_parts(sides, gap_sec):
    left, _, l_df, _ = sides
    parts = run_parts(l_df, ["user"], "l_ts", gap_sec)
    # The parts of two halves are made one before they are joined.
    halves = [run_parts(l_df.where(F.pmod(F.hash("l_id"), F.lit(2)) == k), ["user"], "l_ts", gap_sec) for k in (0, 1)]
    again = run_parts(halves[0].unionByName(halves[1]).withColumnRenamed("first", "l_ts"), ["user"], "l_ts", gap_sec, F.col("n"))
    want = []
    for user in {u for u, *_ in left}:
        run = []
        for s in sorted(s for u, s, _ in left if u == user and s is not None):
            if run and s - run[-1] > gap_sec:
                want.append((user, at(run[0]), at(run[-1]), len(run)))
                run = []
            run.append(s)
        want += [(user, at(run[0]), at(run[-1]), len(run))] if run else []
    for some in (parts, again):
        assert rows(joined_runs(some, ["user"], gap_sec), "user", "first", "last", "n") == sorted(want, key=repr)


def test_a_busy_user_is_many_parts(spark):
    """A user with a third of the events: what reaches one task is an hour of them."""
    events = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, "busy").otherwise(F.concat(F.lit("u"), (F.col("id") % 997).cast("string"))).alias("user"),
        (F.lit(at(0)).cast("timestamp_ntz") + F.make_dt_interval(secs=(F.col("id") * 5).cast("decimal(18,6)"))).alias("l_ts"),
    )
    parts = run_parts(events, ["user"], "l_ts", 8 * 3600)
    assert parts.agg(F.max("n")).first()[0] <= 3600 / 15 + 1
    assert parts.where("user = 'busy'").count() >= 400
    assert rows(joined_runs(parts, ["user"], 8 * 3600).where("user = 'busy'"), "n") == [(100_000,)]


def test_count_pairs_before_without_rows(spark):
    none = frame(spark, [], "l")
    assert rows(count_pairs_before(none, none, ["user"], F.col("l_ts"), F.col("l_ts"))) == [(0,)]


def test_band_limits_are_checked(sides):
    _, _, l_df, r_df = sides
    with pytest.raises(ValueError):
        band_join(l_df, r_df, ["user"], "l_ts", "r_ts", 5, 4)


def test_without_match_keeps_rows_without_key(spark):
    left = spark.createDataFrame([("x", 1), ("y", 2), (None, 3), (None, 4)], "k string, n int")
    right = spark.createDataFrame([("x",), ("x",), (None,)], "r string")
    assert rows(without_match(left, right, {"k": "r"}), "n") == [(2,), (3,), (4,)]


def test_times_before_1970_fall_in_order(spark):
    early = START.replace(year=1969)
    df = spark.createDataFrame([("a", early, "1"), ("a", early.replace(minute=30), "2")], "user string, l_ts timestamp_ntz, l_id string")
    assert rows(with_previous(df, ["user"], "l_ts", "l_id", ["l_id"], chunk_sec=60), "l_id", "prev.l_id") == [("1", None), ("2", "1")]
