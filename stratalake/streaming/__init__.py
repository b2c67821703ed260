"""Incremental forms of the layer runs: each file is processed once, then the run ends."""

from stratalake.streaming.distinct import distinct_trips, upsert_distinct_rows
from stratalake.streaming.ingest import batched, ingest_new_files, ingest_to_table
from stratalake.streaming.refresh import (
    quarantine_new_rows,
    refresh_from_new_batches,
    refresh_from_new_rows,
    upsert_new_rows,
)

__all__ = [
    "batched",
    "distinct_trips",
    "ingest_new_files",
    "ingest_to_table",
    "quarantine_new_rows",
    "refresh_from_new_batches",
    "refresh_from_new_rows",
    "upsert_distinct_rows",
    "upsert_new_rows",
]
