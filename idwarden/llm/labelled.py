"""Labelled rows for training: the same split and the same bound for every classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows that a classifier is fitted on, at most: those of the lowest hash of their id.
TRAIN_ROWS = 8000


def held_out(doc_id: str = "doc_id"):
    """Whether a row is kept from training: crc32 of its id as text, mod 5, is 0. A NULL id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, limit: int = TRAIN_ROWS) -> DataFrame:
    """text and label (0 or 1) of at most ``limit`` rows that are not held out.

    Labels that are NULL do not count; of repeated label rows the smallest label counts; documents that repeat an id all count.
    """
    picked = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    )
    # At most ``limit`` rows of two numbers: safe to broadcast.
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "label")
