"""Periodic runs of words: stretches that repeat a block of q words four times or more.

A run is a stretch of consecutive words with smallest period q, of max(6, 4 * q) words or more, that no neighbouring word extends. For
each q, the words at 0, q, 2 * q, ... form a grid; a run of period q covers four neighbours of it at least, so the extensions of equal grid
points q apart, to the left and to the right, find every run. All grids together have n * ln(n) points for n words (a harmonic sum).

Extensions are longest common extensions (LCE) of two places, answered by a difference cover: of each ``COVER`` places, those whose
remainder is in ``MEMBERS`` are sampled. Any two places reach two sampled ones after the same few words (``REACH``), which are compared
one by one. Only the sampled suffixes are sorted: by their first words, as long as they tie, then by doubling over sampled places. Their
common prefixes, in a sparse table, answer the rest as a range minimum. Extensions to the left are those of the reversed words.

A text is handled whole, whatever its length; short texts share an index, whose extensions are cut at the borders of texts. Work is
n * ln(n) for n words of a text; candidates are made and thinned in blocks of ``PAIRS``. NULL texts and texts without words have no runs.
Repeated rows are handled one by one. With ``rewrite``, rows with a NULL id stay as they are.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from idwarden.llm.arrays import Texts, Words, binaries, ranges, run_starts, starts_of, with_columns
from idwarden.llm.passing import packed, unpacked, widened

LEAST, REPEATS = 6, 4
#: A perfect difference cover: each remainder but 0 is the difference of two members.
COVER, MEMBERS = 31, np.array([0, 1, 3, 8, 12, 18])
PAIRS = 1 << 20
#: The least number of words after which places of these remainders are both sampled.
_SAMPLED = np.zeros(COVER, bool)
_SAMPLED[MEMBERS] = True
REACH = np.array([[next(d for d in range(COVER) if _SAMPLED[(i + d) % COVER] and _SAMPLED[(j + d) % COVER]) for j in range(COVER)] for i in range(COVER)])


class Extensions:
    """Longest common extensions to the right of places in ``keys`` (numbers of 0 and more)."""

    def __init__(self, keys: np.ndarray):
        n = len(keys)
        # No place beyond the end equals another.
        self.keys = np.concatenate([keys, -1 - np.arange(2 * COVER)])
        at = np.flatnonzero(_SAMPLED[np.arange(n + COVER) % COVER])
        self.index = np.full(n + 2 * COVER, -1)
        self.index[at] = np.arange(len(at))
        order, ranks, levels = self._sorted(at)
        self.rank = ranks
        self.lows = [self._neighbours(at, order, levels)]
        width = 1
        while 2 * width <= len(at) - 1:
            low = self.lows[-1]
            self.lows.append(np.minimum(low[: len(low) - width], low[width:]))
            width *= 2

    def _sorted(self, at: np.ndarray):
        """Sampled places in the order of their suffixes, the rank of each, and their ranks by the first COVER, 2 * COVER, ... words."""
        ranks = _refined(np.zeros(len(at), np.int64), np.arange(len(at)), self.keys[at])
        for step in range(1, COVER):
            tied = _tied(ranks)
            if not len(tied):
                break
            ranks = _refined(ranks, tied, self.keys[np.minimum(at[tied] + step, len(self.keys) - 1)])
        levels, width = [ranks], COVER
        while len(tied := _tied(ranks)):
            # The place after ``width`` words has the same remainder, so it is sampled too; past the end nothing ties.
            ranks = _refined(ranks, tied, ranks[self.index[at[tied] + width]])
            levels.append(ranks)
            width *= 2
        order = np.empty(len(at), np.int64)
        order[ranks] = np.arange(len(at))
        return order, ranks, levels

    def _neighbours(self, at: np.ndarray, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Words that neighbours in the order share."""
        a, b = at[order[:-1]].copy(), at[order[1:]].copy()
        common = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            same = np.flatnonzero(levels[k][self.index[a]] == levels[k][self.index[b]])
            for x in (common, a, b):
                x[same] += COVER << k
        active = np.arange(len(a))
        while len(active := active[self.keys[a[active]] == self.keys[b[active]]]):
            for x in (common, a, b):
                x[active] += 1
        return common

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that the suffixes at i and j (i <> j) share."""
        reach = REACH[i % COVER, j % COVER]
        out = np.zeros(len(i), np.int64)
        active = np.arange(len(i))
        for step in range(COVER):
            active = active[reach[active] > step]
            active = active[self.keys[i[active] + step] == self.keys[j[active] + step]]
            if not len(active):
                break
            out[active] = step + 1
        met = np.flatnonzero(out == reach)
        x, y = self.rank[self.index[i[met] + reach[met]]], self.rank[self.index[j[met] + reach[met]]]
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in np.unique(level):
            some = level == k
            row = self.lows[k]
            out[met[some]] += np.minimum(row[low[some]], row[high[some] - (1 << int(k))])
        return out


def _tied(ranks: np.ndarray) -> np.ndarray:
    """Entries whose rank is not theirs alone."""
    return np.flatnonzero(np.bincount(ranks, minlength=len(ranks))[ranks] > 1)


def _refined(ranks: np.ndarray, tied: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Ranks (the number of entries before a group of ties) in which the ``tied`` groups are split by ``second``."""
    order = np.lexsort((second, ranks[tied]))
    tied, second = tied[order], second[order]
    first = ranks[tied]
    groups, begins = run_starts(first), run_starts(first, second)
    inside = begins - groups[np.searchsorted(groups, begins, "right") - 1]
    out = ranks.copy()
    out[tied] = np.repeat(first[begins] + inside, np.diff(np.append(begins, len(tied))))
    return out


def _grid(counts: np.ndarray):
    """Blocks of grid points (text, period, point number) of texts of so many words: those that two periods can follow."""
    periods = counts // REPEATS
    text = np.repeat(np.arange(len(counts)), periods)
    period = ranges(np.ones(len(counts), np.int64), periods)
    points = counts[text] // period - 2
    sums = starts_of(points)
    at = 0
    while at < len(text):
        to = max(int(np.searchsorted(sums, sums[at] + PAIRS, "right")) - 1, at + 1)
        for low in range(0, int(points[at]) if to == at + 1 else 1, PAIRS):
            some = np.minimum(points[at:to] - low, PAIRS)
            yield np.repeat(text[at:to], some), np.repeat(period[at:to], some), ranges(np.full(to - at, low), some)
        at = to


def runs_of(keys: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """text, start (a place in ``keys``), length and period of all runs, by text, start and period. offsets: of texts into keys."""
    found = []
    counts = np.diff(offsets)
    forward = backward = None
    last = max(len(keys) - 1, 0)
    for text, period, point in _grid(counts):
        at = offsets[text] + point * period
        # The point of a run that counts is followed by two periods of equal words: a few of them first.
        good = keys[at] == keys[at + period]
        for shift, scale in ((0, 1), (1, 0), (1, 1), (-1, 2)):
            at, period, text = at[good], period[good], text[good]
            x = at + shift + scale * period
            good = keys[x] == keys[np.minimum(x + period, last)]
        at, period, text = at[good], period[good], text[good]
        if not len(at):
            continue
        if forward is None:
            forward, backward = Extensions(keys), Extensions(keys[::-1])
        left = np.zeros(len(at), np.int64)
        inner = np.flatnonzero(at > offsets[text])
        left[inner] = np.minimum(backward.of(last + 1 - at[inner], last + 1 - at[inner] - period[inner]), at[inner] - offsets[text[inner]])
        first = left < period  # the first point of its grid in the run
        at, period, text, left = at[first], period[first], text[first], left[first]
        ends = offsets[text + 1]
        right = np.minimum(forward.of(at, at + period), ends - at - period)
        length = left + right + period
        run = length >= np.maximum(LEAST, REPEATS * period)
        found.append((text[run], (at - left)[run], length[run], period[run]))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    text, start, length, period = (np.concatenate(x) for x in zip(*found))
    # A stretch is also found with multiples of its smallest period.
    order = np.lexsort((period, length, start, text))
    order = order[run_starts(text[order], start[order], length[order])]
    order = order[np.lexsort((period[order], start[order], text[order]))]
    return text[order], start[order], length[order], period[order]


def _rewritten(ids: pa.Array, counts: np.ndarray) -> np.ndarray:
    """The source word of each word, for texts of so many words: of some texts, by id, the words from a place on repeat a block."""
    out = ranges(np.zeros(len(counts), np.int64), counts)
    offsets = starts_of(counts)
    for row, doc_id in enumerate(ids.to_pylist()):
        n = int(counts[row])
        if doc_id is None or not n or (h := zlib.crc32(str(doc_id).encode())) % 10:
            continue
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        out[offsets[row] + a:offsets[row + 1]] = a + np.arange(n - a) % p
    return out


RUNS = {"n_words": T.LongType(), "runs": T.BinaryType(), "collapsed": T.StringType()}


def find(docs: DataFrame, text: str = "text", rewrite: str | None = None) -> DataFrame:
    """``docs`` with n_words, runs (start, length and period of each, as little-endian 64-bit integers, by start, then period) and
    collapsed: the words, joined by one space, but those that a run holds after its first period.

    rewrite: a column of ids by which some texts are changed first, as a test needs that plants runs.
    """
    rows = packed(docs, *dict.fromkeys([text, *([rewrite] if rewrite else [])]), without=tuple(RUNS))
    schema = widened(rows, RUNS)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            texts = Texts(batch.column(text))
            for first, end in texts.slices():
                new = _found(texts.piece(first, end), batch.column(rewrite).slice(first, end - first) if rewrite else None)
                yield with_columns(batch.slice(first, end - first), arrow, new)

    return unpacked(rows.mapInArrow(run, schema), docs, *dict.fromkeys([text, *([rewrite] if rewrite else [])]), new=tuple(RUNS))


def _found(texts: Texts, ids: pa.Array | None) -> dict[str, pa.Array]:
    words = Words(texts)
    starts, lengths = words.starts, words.ends - words.starts
    if ids is not None:
        chosen = words.offsets[:-1][words.rows] + _rewritten(ids, words.counts)
        starts, lengths = starts[chosen], lengths[chosen]
    spelled = binaries(texts.data[ranges(starts, lengths)], starts_of(lengths)).dictionary_encode()
    keys = spelled.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    text, start, length, period = runs_of(keys, words.offsets)
    edge = np.zeros(len(keys) + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.subtract.at(edge, start + length, 1)
    kept = np.cumsum(edge[:-1]) == 0
    # Each kept word with a space after it; the last space of a text is cut.
    kept_rows = np.bincount(words.rows[kept], minlength=len(texts))
    sizes = lengths[kept] + 1
    data = np.full(int(sizes.sum()), 0x20, np.uint8)
    data[ranges(starts_of(sizes)[:-1], sizes - 1)] = texts.data[ranges(starts[kept], sizes - 1)]
    ends = starts_of(sizes)[starts_of(kept_rows)]
    last = np.zeros(len(data), bool)
    last[ends[1:][kept_rows > 0] - 1] = True
    ends = ends - starts_of(kept_rows > 0)
    runs = np.stack([start - words.offsets[text], length, period], axis=1).astype("<i8")
    return {
        "n_words": pa.array(words.counts.astype(np.int64)),
        "runs": binaries(runs, 24 * starts_of(np.bincount(text, minlength=len(texts)))),
        "collapsed": pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(ends), pa.py_buffer(data[~last])]).cast(pa.string()),
    }


def digests(docs: DataFrame) -> DataFrame:
    """Per row of documents, after the rewriting: its number of runs, its longest run, and digests of the runs and of the collapsed text."""
    longs = ("n_runs", "start", "length", "period", "exponent_milli")
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in longs) + ", listed string, collapsed string"

    def run(batches):
        for batch in batches:
            lists, best = [], {c: [] for c in longs}
            for data in batch.column("runs").to_pylist():
                runs = np.frombuffer(data, "<i8").reshape(-1, 3)
                lists.append("".join(f"{s},{n},{q}\n" for s, n, q in runs.tolist()))
                s, n, q = min(runs.tolist(), key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
                for c, x in zip(longs, (len(runs), s, n, q, None if n is None else 1000 * n // q)):
                    best[c].append(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(best[c], pa.int64()) for c in longs), pa.array(lists, pa.string()), batch.column("collapsed")],
                names=["doc_id", *longs, "listed", "collapsed"],
            )

    found = find(docs.select(F.col("doc_id").cast("long"), "text"), rewrite="doc_id").select("doc_id", "runs", "collapsed")
    return found.mapInArrow(run, schema).select(
        "doc_id", *longs, F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
