from stratalake.sources.delimited import read_delimited, schema_from_header
from stratalake.sources.storage import (
    data_files,
    has_stream_log,
    mark,
    path_exists,
    remove,
    size_in_bytes,
    table_exists,
)
from stratalake.sources.tables import in_partitions, partition_counts, read_files, read_layer

__all__ = [
    "data_files",
    "has_stream_log",
    "in_partitions",
    "mark",
    "partition_counts",
    "path_exists",
    "read_delimited",
    "read_files",
    "read_layer",
    "remove",
    "schema_from_header",
    "size_in_bytes",
    "table_exists",
]
