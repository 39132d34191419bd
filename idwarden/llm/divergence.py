"""How far the sources of a language stand from each other and from the language, by their terms.

Terms are runs of letters (all of Unicode beyond ASCII counts as letters), A-Z lower-cased. A language keeps the terms that at least
``LEAST_DOCS`` of its documents hold. With ``count`` occurrences of a kept term in a group (one source of one language) or in a language,
N the sum of all and V kept terms, its smoothed share in billionths is p = 1 + floor(10**9 * (count + 5) / (N + 5 * V)).

* ``pairs``: for each two sources of a language, the sum of abs(p - q) over all kept terms. Sources are numbered and dealt in tiles of
  ``TILE``; a task takes a part of the terms for two tiles, as a table of sources and terms, and sends one partial sum for each two
  sources on. Terms that neither tile holds are added by their number.
* ``leading``: the ``RANKS`` terms of each group that stand out most against its language. p - q depends on the two counts only, so the
  terms are grouped into cells of (group count, language count); cells of equal value are merged, ranked by the terms they hold, and only
  the cells that reach the first ranks are expanded to terms, in the order of their UTF-8 bytes.

Arithmetic is on whole numbers, in decimals where 64 bits might not do. NULL text, lang and source count as ''. Groups without terms
take part with a count of 0 everywhere; where a language keeps no term, all values of ``pairs`` are 0. Repeated rows are documents of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from idwarden.llm.arrays import LOWER, Texts, Words, binaries, ranges, run_starts, starts_of
from idwarden.llm.store import save, shuffle_partitions, small

LEAST_DOCS, RANKS = 30, 50
#: Sources of a tile; entries of the table of sources and terms that are looked at together; rows that a task holds back to merge.
TILE, TABLE_ENTRIES, HELD_ROWS = 256, 1 << 21, 1 << 19

#: Bytes between terms: 0x00 to 0x40, 0x5B to 0x60, 0x7B to 0x7F.
APART = np.zeros(256, bool)
APART[[*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True

_COUNTS = "lang string, source string, term string, n long, docs long"
_KEYS = ["lang", "source", "term"]


def _counted(texts: Texts, langs: pa.Array, sources: pa.Array) -> pa.Table:
    """Occurrences and documents of each term in each group of these texts."""
    words = Words(texts, APART)
    lengths = words.ends - words.starts
    spelled = binaries(LOWER[texts.data][ranges(words.starts, lengths)], starts_of(lengths)).dictionary_encode()
    size = max(len(spelled.dictionary), 1)
    term = spelled.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    by_text, n = np.unique(words.rows * size + term, return_counts=True)
    langs, sources = langs.dictionary_encode(), sources.dictionary_encode()
    group = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64) * max(len(sources.dictionary), 1) + sources.indices.to_numpy(zero_copy_only=False)
    key = group[by_text // size] * size + by_text % size
    order = np.argsort(key, kind="stable")
    begins = run_starts(key[order])
    key = key[order][begins]
    held = divmod(key // size, max(len(sources.dictionary), 1))
    return pa.table({
        "lang": langs.dictionary.take(pa.array(held[0])), "source": sources.dictionary.take(pa.array(held[1])),
        "term": spelled.dictionary.take(pa.array(key % size)).cast(pa.string()),
        "n": np.add.reduceat(n[order], begins) if len(begins) else n[:0], "docs": np.diff(np.append(begins, len(order))),
    })


def _merged(parts: list[pa.Table]) -> pa.Table:
    table = pa.concat_tables(parts).group_by(_KEYS).aggregate([("n", "sum"), ("docs", "sum")])
    return table.select([*_KEYS, "n_sum", "docs_sum"]).rename_columns([*_KEYS, "n", "docs"])


def term_counts(rows: DataFrame) -> DataFrame:
    """lang, source, term, n and docs, summed within parts of each task. rows: lang, source, text."""
    def run(batches):
        held, size = [], 0
        for batch in batches:
            texts = Texts(batch.column("text"))
            for first, end in texts.slices():
                held.append(_counted(texts.piece(first, end), *(batch.column(c).slice(first, end - first) for c in ("lang", "source"))))
                size += held[-1].num_rows
                if size >= HELD_ROWS:
                    held = [_merged(held)]
                    size = held[0].num_rows
                    if 2 * size >= HELD_ROWS:  # merging does not help any more
                        yield from held[0].to_batches(1 << 16)
                        held, size = [], 0
        if held:
            yield from _merged(held).to_batches(1 << 16)

    return rows.mapInArrow(run, _COUNTS)


def _share(count: str, total: str):
    """p in billionths, exact."""
    return F.expr(f"CASE WHEN {total} + 5 * v > 0 THEN 1 + (cast({count} + 5 AS decimal(20, 0)) * 1000000000BD) div cast({total} + 5 * v AS decimal(20, 0)) ELSE 0 END")


class Audit:
    """Kept terms and groups of ``docs``, written once and read by both parts."""

    def __init__(self, docs: DataFrame, least_docs: int = LEAST_DOCS):
        rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
        # Dealt by term once: the sums by group and by language need no further shuffle.
        summed = term_counts(rows).repartition("lang", "term").groupBy(*_KEYS).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        whole = Window.partitionBy("lang", "term")
        kept = summed.select(
            *_KEYS, "n", F.sum("n").over(whole).alias("lang_n"), F.sum("docs").over(whole).alias("lang_docs"),
            (F.row_number().over(whole.orderBy("source")) == 1).cast("long").alias("one"),
        ).where(F.col("lang_docs") >= least_docs)
        #: lang, source, term, n, lang_n, and one: 1 for one of the rows of each term of a language.
        self.kept = save(kept, "terms")
        totals = self.kept.groupBy("lang").agg(F.sum("one").alias("v"), F.sum("n").alias("lang_total"))
        own = self.kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = rows.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(totals, "lang", "left").select(
            "lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "v", "lang_total")),
            (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("number"),
        )
        #: One row for each group: total and lang_total are N, number counts the sources of a language.
        self.groups = save(groups.withColumn("none", _share("0", "total")), "groups")

    def leading(self, ranks: int = RANKS) -> DataFrame:
        """lang, source, item (a term), value and rank of the first terms of each group."""
        keys = ["lang", "source", "n", "lang_n"]
        cells = self.kept.groupBy(*keys).agg(F.count("*").alias("terms")).join(small(self.groups), ["lang", "source"])
        cells = save(cells.select(*keys, "terms", (_share("n", "total") - _share("lang_n", "lang_total")).alias("value")).where("value > 0"), "cells")
        group = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
        # Each value holds a term at least, so the first values hold all of the first ranks.
        values = cells.groupBy("lang", "source", "value").agg(F.sum("terms").alias("terms")).withColumn("nth", F.row_number().over(group)).where(F.col("nth") <= ranks)
        values = values.withColumn("before", F.sum("terms").over(group) - F.col("terms")).where(F.col("before") < ranks)
        wanted = small(save(cells.join(values.select("lang", "source", "value", "before"), ["lang", "source", "value"]).drop("terms"), "values"))
        terms = self.kept.join(wanted, keys)
        place = F.row_number().over(Window.partitionBy("lang", "source", "value", "before").orderBy("term"))
        return terms.withColumn("place", place).where(F.col("place") <= ranks).select(
            "lang", "source", F.col("term").alias("item"), "value", (F.col("before") + F.col("place")).cast("int").alias("rank"),
        ).where(F.col("rank") <= ranks)

    def pairs(self) -> DataFrame:
        """lang, source, item (another source), value and rank of all pairs of sources of a language."""
        parts = shuffle_partitions(self.kept.sparkSession)
        groups = small(self.groups)
        tiles = (F.col("number") / TILE).cast("int")
        most = self.groups.groupBy("lang").agg((F.max("number") / TILE).cast("int").alias("last_tile"))
        sources = save(self.groups.join(most, "lang").select("lang", "source", "total", "v", "number", "none", "last_tile", tiles.alias("tile")), "tiles")
        met = F.explode(F.sequence(F.lit(0), "last_tile")).alias("other")
        cell = (F.least("tile", "other").alias("first"), F.greatest("tile", "other").alias("second"))
        present = self.kept.join(small(sources), ["lang", "source"]).select(
            "lang", "number", "tile", met, F.pmod(F.xxhash64("term"), F.lit(parts)).cast("int").alias("part"), "term", _share("n", "total").alias("p"))
        absent = sources.select("lang", "number", "tile", met, F.col("none").alias("p")).select(
            "lang", "number", "tile", "other", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(None).cast("string").alias("term"), "p")
        entries = present.unionByName(absent).select("lang", *cell, "part", "number", "term", "p")
        partial = entries.repartition(parts, "lang", "first", "second", "part").mapInArrow(_distances, "lang string, a int, b int, value long, terms long")
        sums = partial.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"))
        sides = [groups.select("lang", F.col("number").alias(s), F.col("source").alias(f"source_{s}"), F.col("none").alias(f"none_{s}"), *extra)
                 for s, extra in (("a", ["v"]), ("b", []))]
        both = sums.join(sides[0], ["lang", "a"]).join(sides[1], ["lang", "b"])
        both = both.withColumn("value", F.col("value") + (F.col("v") - F.col("terms")) * F.abs(F.col("none_a") - F.col("none_b")))
        ways = F.explode(F.array(*(F.struct(F.col(f"source_{x}").alias("source"), F.col(f"source_{y}").alias("item")) for x, y in ("ab", "ba")))).alias("way")
        rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
        return both.select("lang", ways, "value").select("lang", "way.*", "value").select("lang", "source", "item", "value", rank.cast("int").alias("rank"))


def _distances(batches):
    """Partial sums over the terms of a part, for all two sources of two tiles. A row without a term holds a source's p of absent terms."""
    kept = [b for b in batches if b.num_rows]
    if not kept:
        return
    table = pa.Table.from_batches(kept).combine_chunks()
    lang = table.column("lang").combine_chunks().dictionary_encode()
    spelled = table.column("term").combine_chunks().dictionary_encode()
    codes = lang.indices.to_numpy(zero_copy_only=False)
    term = spelled.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    first, second, part, number, p = (table.column(c).to_numpy() for c in ("first", "second", "part", "number", "p"))
    order = np.lexsort((term, part, second, first, codes))
    codes, first, second, part, number, p, term = (x[order] for x in (codes, first, second, part, number, p, term))
    begins = run_starts(codes, first, second, part)
    for at, end in zip(begins, np.append(begins[1:], len(order))):
        absent = at + int(np.searchsorted(term[at:end], 0))
        sources = np.sort(number[at:absent])
        none = np.empty(len(sources), np.int64)
        none[np.searchsorted(sources, number[at:absent])] = p[at:absent]
        row = np.searchsorted(sources, number[absent:end])
        new = run_starts(term[absent:end])
        column = np.repeat(np.arange(len(new)), np.diff(np.append(new, end - absent)))
        mine = sources // TILE == first[at]
        theirs = sources // TILE == second[at]
        sums = np.zeros((len(sources), len(sources)), np.int64)
        step = max(TABLE_ENTRIES // len(sources), 1)
        for begin in range(0, len(new), step):
            some = slice(*np.searchsorted(column, [begin, begin + step]))
            shares = np.repeat(none[:, None], min(step, len(new) - begin), axis=1)
            shares[row[some], column[some] - begin] = p[absent:end][some]
            for x in np.flatnonzero(mine):
                sums[x] += np.abs(shares - shares[x]).sum(axis=1)
        a, b = np.nonzero(mine[:, None] & theirs[None, :] & (sources[:, None] < sources[None, :]))
        yield pa.RecordBatch.from_arrays([
            pa.array([lang.dictionary[codes[at]].as_py()] * len(a), pa.string()), pa.array(sources[a].astype(np.int32)), pa.array(sources[b].astype(np.int32)),
            pa.array(sums[a, b]), pa.array(np.full(len(a), len(new))),
        ], names=["lang", "a", "b", "value", "terms"])


def report(docs: DataFrame) -> DataFrame:
    """Both parts: lang, source, part, item, value, rank."""
    audit = Audit(docs)
    columns = ("lang", "source", "part", "item", "value", "rank")
    return audit.pairs().withColumn("part", F.lit("pair")).select(*columns).unionByName(
        audit.leading().withColumn("part", F.lit("term")).select(*columns))
