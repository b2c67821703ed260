"""Technical columns that Bronze adds to the raw rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions import parse_date, source_modified_at, source_path


def with_lineage(raw: DataFrame) -> DataFrame:
    """Add the source file and its modification time. ``raw`` must come straight from files."""
    return raw.withColumns({"ingestion_timestamp": source_modified_at(), "source_file": source_path()})


def with_pickup_date(raw: DataFrame, pickup: str = "tpep_pickup_datetime") -> DataFrame:
    """Add the pickup day and the partition columns; all three are NULL if it does not parse."""
    day = parse_date(pickup)
    return raw.withColumns({"pickup_date": day, "year": F.year(day), "month": F.month(day)})
