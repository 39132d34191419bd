"""Columns that an operator does not use travel through its tasks as one, so their names matter to nothing in between."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REST = "__rest"


def packed(docs: DataFrame, *used: str, without: tuple[str, ...] = ()) -> DataFrame:
    """The ``used`` columns, and all others but ``without`` as one."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (*used, *without)]
    return docs.select(*(F.col(f"`{c}`").alias(c) for c in used), F.struct(*others, F.lit(0).alias("__")).alias(REST))


def widened(rows: DataFrame, new: dict[str, T.DataType]) -> T.StructType:
    """The schema of ``rows`` with the columns ``new`` after them."""
    return T.StructType([*rows.schema.fields, *(T.StructField(k, v) for k, v in new.items())])


def unpacked(rows: DataFrame, docs: DataFrame, *used: str, new: tuple[str, ...] = (), without: tuple[str, ...] = ()) -> DataFrame:
    """The columns of ``docs`` in their order, but those of ``new`` and ``without``; then ``new``."""
    old = [c for c in docs.columns if c not in (*new, *without)]
    return rows.select(*(F.col(c) if c in used else F.col(REST).getField(c).alias(c) for c in old), *new)
