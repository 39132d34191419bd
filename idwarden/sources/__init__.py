from idwarden.sources.bundle import Sources, load_sources
from idwarden.sources.normalise import (
    drop_repeats,
    flatten_messages,
    initiator_counts,
    normalise,
    parse_messages,
    service_initiators,
    to_messages,
)
from idwarden.sources.readers import (
    empty_source,
    has_column,
    is_empty,
    list_files,
    read_csv,
    read_json_lines,
    read_ledger,
    read_parquet,
    record_files,
    source_for_file,
    unseen_files,
)

__all__ = [
    "Sources",
    "drop_repeats",
    "empty_source",
    "flatten_messages",
    "has_column",
    "initiator_counts",
    "is_empty",
    "list_files",
    "load_sources",
    "normalise",
    "parse_messages",
    "read_csv",
    "read_json_lines",
    "read_ledger",
    "read_parquet",
    "record_files",
    "service_initiators",
    "source_for_file",
    "to_messages",
    "unseen_files",
]
