from stratalake.sinks.catalog import columns_of, create_table, place_partitions, register_table, registered_location
from stratalake.sinks.jdbc import export_jdbc, jdbc_options
from stratalake.sinks.partitioned import append_or_create, write_partitioned
from stratalake.sinks.pending import finish_pending
from stratalake.sinks.upsert import UpsertResult, first_per_key_over, upsert_first_per_key, upsert_table
from stratalake.sinks.versions import finish_moving, remove_unreferenced, upsert_by_location

__all__ = [
    "UpsertResult",
    "append_or_create",
    "columns_of",
    "create_table",
    "export_jdbc",
    "finish_moving",
    "finish_pending",
    "first_per_key_over",
    "jdbc_options",
    "place_partitions",
    "register_table",
    "registered_location",
    "remove_unreferenced",
    "upsert_by_location",
    "upsert_first_per_key",
    "upsert_table",
    "write_partitioned",
]
