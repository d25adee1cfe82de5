from shelfmark.sources.layers import (
    file_ranges,
    file_schema,
    inferred_layer,
    read_layer,
    read_ranked,
    read_version,
    write_bronze,
    write_mart,
    write_silver,
)
from shelfmark.sources.raw import read_raw, unreadable_values, with_ingest_metadata

__all__ = [
    "file_ranges",
    "file_schema",
    "inferred_layer",
    "read_layer",
    "read_ranked",
    "read_raw",
    "read_version",
    "unreadable_values",
    "with_ingest_metadata",
    "write_bronze",
    "write_mart",
    "write_silver",
]
