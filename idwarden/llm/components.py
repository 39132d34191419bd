"""Connected components of an edge table, by alternating large and small stars.

Each round hangs every node below the smallest node it knows of; the number of rounds grows with the logarithm of the
longest path. Edges of a busy node are never gathered: its smallest neighbour is an aggregate, joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idwarden.llm.store import save


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) of all nodes of ``edges`` (a, b: long). Loops and repeats do no harm."""
    edges = save(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        edges = save(
            joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v")))
            .where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges",
        )
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    """Number and checksum of the edges."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
