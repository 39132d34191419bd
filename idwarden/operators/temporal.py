"""Joins and look-backs along time, safe for users that hold a large share of the rows.

Every operator here splits a key's history into time chunks and shuffles on
(key, chunk), so one busy account spreads over many tasks. What has to cross a chunk
border travels as one summary row per (key, chunk). Rows that share a key and a time are
combined before they meet, so copies of one event do not fill a task either.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from idwarden.functions import all_not_null, any_null, elapsed, seconds
from idwarden.functions.checks import ordered, positive
from idwarden.operators.keyed import shuffled

CHUNK_SEC = 3600


def _chunk(ts, width_sec: int) -> Column:
    return F.floor(seconds(ts) / F.lit(width_sec))


def _covered(ts: str, lo: int, hi: int, width: int) -> Column:
    """All chunks of ``width`` that the band [ts + lo, ts + hi] touches."""
    first = F.floor((seconds(ts) + F.lit(lo)) / F.lit(width))
    last = F.floor((seconds(ts) + F.lit(hi)) / F.lit(width))
    return F.sequence(first, last)


def band_join(
    left: DataFrame, right: DataFrame, on: list[str], left_ts: str, right_ts: str, lo: int, hi: int,
) -> DataFrame:
    """Inner join on ``on`` where ``lo <= right_ts - left_ts <= hi`` in whole seconds.

    Each left row is copied to the one or two chunks its band touches, each right row
    has one chunk, so no pair is found twice and no key's rows meet all at once.
    ``left`` should be the smaller side. Both sides may share only the ``on`` columns.
    """
    ordered("lo", lo, "hi", hi)
    width = hi - lo + 1
    near = left.where(all_not_null(*on)).withColumn("_chunk", F.explode(_covered(left_ts, lo, hi, width)))
    far = right.withColumn("_chunk", _chunk(right_ts, width))
    return (
        near.join(shuffled(far), [*on, "_chunk"])
        .where(elapsed(right_ts, left_ts).between(lo, hi))
        .drop("_chunk")
    )


def without_band_match(
    left: DataFrame, right: DataFrame, on: list[str], left_ts: str, right_ts: str, lo: int, hi: int,
) -> DataFrame:
    """Rows of ``left`` with no ``right`` row on the same keys and ``lo <= right_ts - left_ts <= hi``.

    The right side keeps one row per key and second, which bounds a chunk's candidates
    by its width in seconds however many copies the input holds. Left rows without key or time have
    no match and skip the join.
    """
    ordered("lo", lo, "hi", hi)
    width = hi - lo + 1
    known = (
        right.where(all_not_null(*on, right_ts))
        .select(*on, seconds(right_ts).alias("_sec"))
        .distinct()
        .select(
            *[F.col(k).alias(f"_r_{k}") for k in on],
            "_sec",
            F.explode(
                F.sequence(
                    F.floor((F.col("_sec") - F.lit(hi)) / F.lit(width)),
                    F.floor((F.col("_sec") - F.lit(lo)) / F.lit(width)),
                )
            ).alias("_r_chunk"),
        )
    )
    dated = left.where(all_not_null(*on, left_ts)).withColumn("_chunk", _chunk(left_ts, width))
    match = F.col("_chunk") == F.col("_r_chunk")
    for k in on:
        match = match & (F.col(k) == F.col(f"_r_{k}"))
    match = match & (F.col("_sec") - seconds(left_ts)).between(lo, hi)
    return (
        dated.join(shuffled(known), match, "left_anti")
        .drop("_chunk")
        .unionByName(left.where(any_null(*on, left_ts)))
    )


def asof_scan(
    left: DataFrame, right: DataFrame, on: list[str], left_ts: str, right_ts: str, right_id: str,
    targets: dict[str, Column], *, keep: dict[str, Column] | None = None, forward: bool = False, strict: bool = False,
    whole_seconds: bool = False, within_sec: int | None = None, chunk_sec: int = CHUNK_SEC,
) -> DataFrame:
    """For each (``on``, ``left_ts``) of ``left`` the nearest earlier (``forward``: later) ``right`` row of each target, in one pass.

    ``targets`` are conditions on ``right``; each gives a struct of its columns but the keys, (``right_ts``, ``right_id``) first, or NULL.
    Ties go to the row nearest by that struct. ``keep`` are expressions on ``left`` of which the smallest of each time is returned.
    ``strict`` shuts out equal times, ``whole_seconds`` compares times by second, ``within_sec`` bounds the distance.

    No pairs are formed: both sides are combined by time, in one shuffle for all targets, and scanned in order per (key, chunk) in
    another. With a bound, right rows are copied to the chunks their band reaches; without one, a row per (key, chunk)
    tells what came before it.
    """
    positive(chunk_sec=chunk_sec)
    keep = keep or {}
    at = seconds if whole_seconds else F.col
    best, direction = (F.min, F.desc) if forward else (F.max, F.asc)
    width = chunk_sec if within_sec is None else max(chunk_sec, within_sec)
    left_turn, right_turn = (0, 1) if strict else (1, 0)
    chunk = [*on, "_chunk"]

    payload = F.struct(right_ts, right_id, *[c for c in right.columns if c not in (*on, right_ts, right_id)])
    if within_sec is None:
        reached = _chunk(right_ts, width)
    else:
        reached = F.explode(_covered(right_ts, -within_sec, 0, width) if forward else _covered(right_ts, 0, within_sec, width))
    lefts = left.where(all_not_null(*on, left_ts)).select(
        *on, _chunk(left_ts, width).alias("_chunk"), at(left_ts).alias("_at"), F.lit(left_turn).alias("_turn"), left_ts,
        *[c.alias(name) for name, c in keep.items()],
    )
    rights = right.where(all_not_null(*on, right_ts) & reduce(Column.__or__, targets.values())).select(
        *on, reached.alias("_chunk"), at(right_ts).alias("_at"), F.lit(right_turn).alias("_turn"),
        *[F.when(wanted, payload).alias(name) for name, wanted in targets.items()],
    )
    # The chunks are stated to be known, so that both uses of the points get the same filters and share their shuffles.
    points = lefts.unionByName(rights, allowMissingColumns=True).where(F.col("_chunk").isNotNull()).groupBy(
        *chunk, "_at", "_turn", left_ts
    ).agg(*[F.min(name).alias(name) for name in keep], *[best(name).alias(name) for name in targets])
    in_order = Window.partitionBy(*chunk).orderBy(direction("_at"), "_turn", left_ts)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    passed = points.withColumns({
        **{name: F.last(name, ignorenulls=True).over(so_far) for name in targets}, "_next": F.lead("_turn").over(in_order)
    })
    scanned = passed.where(F.col("_turn") == left_turn)
    if within_sec is None:
        # What the last row of each chunk has seen is handed to the chunks after it.
        before = Window.partitionBy(*on).orderBy(direction("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
        carried = passed.where(F.col("_next").isNull()).select(
            *chunk, *[F.last(name, ignorenulls=True).over(before).alias(f"_before_{name}") for name in targets]
        )
        scanned = scanned.join(carried, chunk).withColumns({name: F.coalesce(name, f"_before_{name}") for name in targets})
    else:
        scanned = scanned.withColumns({
            name: F.when(F.abs(elapsed(F.col(f"{name}.{right_ts}"), left_ts)) <= F.lit(within_sec), F.col(name)) for name in targets
        })
    return scanned.select(*on, left_ts, *keep, *targets)


def asof_join(
    left: DataFrame, right: DataFrame, on: list[str], left_ts: str, right_ts: str, right_id: str,
    *, forward: bool = False, strict: bool = False, whole_seconds: bool = False,
    within_sec: int | None = None, how: str = "inner", chunk_sec: int = CHUNK_SEC, match: str = "match",
) -> DataFrame:
    """Attach to each left row the nearest earlier (``forward``: later) right row on the same keys, by ``asof_scan``.

    The right row comes as one struct column ``match`` without the key columns. ``how='left'`` keeps rows with no
    match. However many rows share a time, the scan sees it once per side.
    """
    matches = asof_scan(
        left.select(*on, left_ts), right, on, left_ts, right_ts, right_id, {match: F.lit(True)}, forward=forward, strict=strict,
        whole_seconds=whole_seconds, within_sec=within_sec, chunk_sec=chunk_sec,
    ).where(F.col(match).isNotNull())
    found = left.where(all_not_null(*on, left_ts)).join(matches, [*on, left_ts], how).select(*left.columns, match)
    if how == "inner":
        return found
    return found.unionByName(left.where(any_null(*on, left_ts)), allowMissingColumns=True)


def with_previous(
    df: DataFrame, on: list[str], ts: str, row_id: str, carry: list[str],
    *, within_sec: int | None = None, chunk_sec: int = CHUNK_SEC, name: str = "prev",
) -> DataFrame:
    """Add a struct with the ``carry`` columns of the row before, in (ts, row_id) order per key.

    Rows without key or time have no place in the order and are left out. With ``within_sec`` a row
    further back may come as NULL; callers that look no further than that save all shuffles but one, as
    rows near the end of a chunk are copied to the next.
    """
    positive(chunk_sec=chunk_sec)
    dated = df.where(all_not_null(*on, ts))
    if within_sec is not None:
        width = max(chunk_sec, 4 * within_sec)  # at most a quarter of the rows are copied
        rows = dated.withColumn("_chunk", F.explode(_covered(ts, 0, within_sec, width)))
        before = Window.partitionBy(*on, "_chunk").orderBy(ts, row_id)
        return (
            rows.withColumn(name, F.lag(F.struct(*carry)).over(before)).where(F.col("_chunk") == _chunk(ts, width)).drop("_chunk")
        )
    rows = dated.withColumn("_chunk", _chunk(ts, chunk_sec)).withColumn("_own", F.struct(*carry))
    ends = rows.groupBy(*on, "_chunk").agg(F.max_by("_own", F.struct(ts, row_id)).alias("_own"))
    by_chunk = Window.partitionBy(*on).orderBy("_chunk")
    carried = ends.withColumn("_own", F.lag("_own").over(by_chunk)).where(F.col("_own").isNotNull())
    in_chunk = Window.partitionBy(*on, "_chunk").orderBy("_turn", ts, row_id)
    return (
        rows.withColumn("_turn", F.lit(1))
        .unionByName(carried.withColumn("_turn", F.lit(0)), allowMissingColumns=True)
        .withColumn(name, F.lag("_own").over(in_chunk))
        .where(F.col("_turn") == 1)
        .drop("_chunk", "_own", "_turn")
    )


def run_parts(df: DataFrame, on: list[str], ts: str, gap_sec: int, n: Column | None = None) -> DataFrame:
    """Parts of runs: per key and stretch of time no longer than the gap, the first and last event and the number of events.

    Events of one stretch are one run whatever lies between them, so a part is a plain aggregate, combined on the map side: a
    busy key leaves one row per stretch, not one per event. ``ts`` of parts may be given again, with ``last`` and their number ``n``.
    """
    positive(gap_sec=gap_sec)
    last = F.col("last") if "last" in df.columns else F.col(ts)
    return df.where(F.col(ts).isNotNull()).groupBy(*on, _chunk(ts, min(gap_sec, CHUNK_SEC)).alias("_chunk")).agg(
        F.min(ts).alias("first"), F.max(last).alias("last"), F.sum(F.lit(1) if n is None else n).alias("n")
    )


def joined_runs(parts: DataFrame, on: list[str], gap_sec: int) -> DataFrame:
    """Runs of events without a pause over ``gap_sec`` (to the microsecond), from ``run_parts``: keys, first, last and n."""
    in_order = Window.partitionBy(*on).orderBy("first")
    pause = F.make_dt_interval(secs=F.lit(gap_sec))
    new = F.coalesce(F.col("first") > F.lag("last").over(in_order) + pause, F.lit(True)).cast("int")
    numbered = parts.withColumn("_new", new).withColumn("_run", F.sum("_new").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*on, "_run").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n")).drop("_run")


def count_pairs_before(
    left: DataFrame, right: DataFrame, on: list[str], left_ts: Column, right_ts: Column, *, chunk_sec: int = CHUNK_SEC,
) -> DataFrame:
    """One row ``n``: how many (left, right) pairs on equal keys have ``right_ts < left_ts``.

    The pairs are counted, not formed. Rows are first summed up by time; inside a chunk a running sum
    then meets each time, across chunks the per-chunk totals do.
    """
    def marked(df, ts, is_left):
        rows = df.where(all_not_null(*on) & ts.isNotNull())
        return rows.select(*on, ts.alias("_ts"), F.lit(is_left).alias("_l"), F.lit(1 - is_left).alias("_r"))

    sums = [F.sum("_l").alias("_l"), F.sum("_r").alias("_r")]
    times = (
        marked(left, left_ts, 1)
        .unionByName(marked(right, right_ts, 0))
        .groupBy(*on, _chunk("_ts", chunk_sec).alias("_chunk"), "_ts")
        .agg(*sums)
    )
    totals = times.groupBy(*on, "_chunk").agg(*sums)

    def pairs(rows, by, order):
        before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumn("_n", F.col("_l") * F.sum("_r").over(before)).agg(F.sum("_n").alias("_n"))

    inside = pairs(times, [*on, "_chunk"], "_ts")
    across = pairs(totals, on, "_chunk")
    return inside.unionByName(across).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"))
