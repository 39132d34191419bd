"""Raw rows to the fixed layout of a source."""

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from idwarden import schemas
from idwarden.constants import ACTION_ACCOUNTS, DEFAULT_ACCOUNT, GROUP_ACCOUNTS, HUMAN_PREFIX
from idwarden.functions import blank_to_null, first_rows


def _shaped(df: DataFrame, field: T.StructField) -> Column:
    """One column of the layout: cast without failing on bad text, absent columns as NULL."""
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType).alias(field.name)
    column = F.col(f"`{field.name}`")
    is_text = isinstance(df.schema[field.name].dataType, T.StringType)
    if isinstance(field.dataType, T.StringType):
        column = column.cast("string")
        return (blank_to_null(column) if field.name in schemas.BLANK_MEANS_NULL else column).alias(field.name)
    if is_text:
        column = blank_to_null(column)
    return column.try_cast(field.dataType).alias(field.name)


def normalise(df: DataFrame, source: str, extra: list[str] | None = None) -> DataFrame:
    """Bring raw rows to the layout of ``source``: current names, types, NULL for blank keys.

    ``extra`` names further columns to keep when present, such as ``attr_source`` or ``_raw``.
    """
    layout = [shaped_field(df, source, field.name) for field in schemas.BY_SOURCE[source].fields]
    return df.select(*layout, *[c for c in extra or [] if c in df.columns])


def shaped_field(df: DataFrame, source: str, name: str) -> Column:
    """A column of the layout, from its name or, where that has no value, from an older name."""
    field = schemas.BY_SOURCE[source][name]
    older = [old for old, new in schemas.ALIASES[source].items() if new == name and old in df.columns and old not in schemas.BY_SOURCE[source].names]
    names = [n for n in (name, *older) if n in df.columns]
    if names in ([], [name]):
        return _shaped(df, field)
    return F.coalesce(*(_shaped(df.select(n), T.StructField(n, field.dataType)) for n in names)).alias(name)


def to_messages(df: DataFrame, source: str) -> DataFrame:
    """One JSON message per row, every value as text, with its source as an attribute."""
    texts = F.struct(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns])
    return df.select(
        F.to_json(texts).alias("payload"),
        F.create_map(F.lit("source"), F.lit(source)).alias("attributes"),
    )


def parse_messages(df: DataFrame, source: str) -> DataFrame:
    """Parse the column ``payload`` into the string fields of ``source``; other columns stay.

    A payload that is not a JSON object gives NULL fields and keeps its text in ``_raw``.
    """
    layout = schemas.text_schema(source)
    for old in schemas.ALIASES[source]:
        layout = layout.add(old, T.StringType(), True) if old not in layout.fieldNames() else layout
    layout = layout.add("_raw", T.StringType(), True)
    parsed = F.from_json("payload", layout, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_raw"})
    fields = df.withColumn("_parsed", parsed)
    others = [c for c in df.columns if c != "payload"]
    # A JSON scalar or null parses to no object at all.
    raw = F.coalesce(F.col("_parsed._raw"), F.when(F.col("_parsed").isNull(), F.col("payload")))
    names = [n for n in layout.fieldNames() if n != "_raw"]
    flat = fields.select(*others, *[F.col(f"_parsed.`{n}`").alias(n) for n in names], raw.alias("_raw"))
    # An alias counts only where the current name has no value.
    for old, new in schemas.ALIASES[source].items():
        flat = flat.withColumn(new, F.coalesce(new, old)).drop(old)
    return flat


def flatten_messages(df: DataFrame, source: str, attributes: tuple[str, ...] = ("source",)) -> DataFrame:
    """Messages (``payload``, ``attributes``) to the layout of ``source`` plus ``attr_*`` and ``_raw``."""
    named = {f"attr_{a}": F.col("attributes")[a] for a in attributes}
    flat = parse_messages(df.withColumns(named).drop("attributes"), source)
    return normalise(flat, source, extra=[*named, "_raw"])


def drop_repeats(df: DataFrame, source: str) -> DataFrame:
    """One row per event id; rows without an id are all kept, and do not meet in one task."""
    event_id = schemas.EVENT_ID[source]
    unique = df.where(F.col(event_id).isNotNull()).dropDuplicates([event_id])
    return unique.unionByName(df.where(F.col(event_id).isNull()))


def _lookup(table: dict[str, str], key: str) -> Column:
    entries = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    return F.try_element_at(entries, F.col(key))


def service_initiators(directory: DataFrame) -> DataFrame:
    """Replace human initiators by the service account of the action, else of the group, else the default."""
    is_human = F.col("initiator").startswith(HUMAN_PREFIX)
    account = F.coalesce(_lookup(ACTION_ACCOUNTS, "action"), _lookup(GROUP_ACCOUNTS, "group"), F.lit(DEFAULT_ACCOUNT))
    return directory.withColumn("initiator", F.when(is_human, account).otherwise(F.col("initiator")))


def initiator_counts(directory: DataFrame, top: int | None = 10) -> DataFrame:
    """The ``top`` most frequent initiators (None: all), and whether each is a person."""
    return first_rows(
        directory.where(F.col("initiator").isNotNull())
        .groupBy("initiator")
        .agg(F.count("*").alias("n"))
        .withColumn("is_human", F.col("initiator").startswith(HUMAN_PREFIX))
        .orderBy(F.desc("n"), "initiator"),
        top,
    )
