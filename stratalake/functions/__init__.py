from stratalake.functions.parsing import (
    exact_amount,
    parse_date,
    parse_timestamp,
    to_double,
    to_int,
)
from stratalake.functions.lineage import source_path, source_modified_at

__all__ = [
    "exact_amount",
    "parse_date",
    "parse_timestamp",
    "source_modified_at",
    "source_path",
    "to_double",
    "to_int",
]
