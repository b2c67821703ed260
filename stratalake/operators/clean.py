"""Typing, date validation and deduplication of trips on their way into Silver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.config import DATE_FORMAT, DEDUP_KEYS, LATEST_ARRIVAL, MERGE_KEYS, PARTITION_COLUMNS, RESCUED
from stratalake.functions import parse_timestamp, to_double, to_int
from stratalake.operators.dedup import first_per_key


def typed_trips(trips: DataFrame) -> DataFrame:
    return trips.withColumns(
        {
            "pickup_ts": parse_timestamp("tpep_pickup_datetime"),
            "dropoff_ts": parse_timestamp("tpep_dropoff_datetime"),
            "passenger_count": to_int("passenger_count"),
            "trip_distance": to_double("trip_distance"),
        }
    )


def with_valid_dates(typed: DataFrame) -> DataFrame:
    return typed.filter(F.col("pickup_ts").isNotNull() & F.col("dropoff_ts").isNotNull())


def fitting_trips(trips: DataFrame) -> DataFrame:
    """Rows whose record had a fitting value for each column. Without a column of rescued records, all rows."""
    return trips.filter(F.col(RESCUED).isNull()).drop(RESCUED) if RESCUED in trips.columns else trips


def rejected_trips(trips: DataFrame) -> DataFrame:
    """The rows that ``fitting_trips`` or ``with_valid_dates`` drops, as they arrived, with the reason."""
    no_pickup = parse_timestamp("tpep_pickup_datetime").isNull()
    no_dropoff = parse_timestamp("tpep_dropoff_datetime").isNull()
    reason = (
        F.when(no_pickup & no_dropoff, F.lit("pickup and dropoff not a timestamp"))
        .when(no_pickup, F.lit("pickup not a timestamp"))
        .when(no_dropoff, F.lit("dropoff not a timestamp"))
    )
    rejected = no_pickup | no_dropoff
    if RESCUED in trips.columns:
        misfit = F.col(RESCUED).isNotNull()
        rejected, reason = rejected | misfit, reason.when(misfit, F.lit("record does not fit its columns"))
    return trips.filter(rejected).withColumn("reject_reason", reason)


def with_trip_period(typed: DataFrame) -> DataFrame:
    """Add the pickup day as text and recompute the partition columns from the typed pickup.

    ``ingestion_date`` is the day of the trip, despite its name.
    """
    pickup = F.col("pickup_ts")
    return typed.withColumns(
        {
            "ingestion_date": F.date_format(pickup, DATE_FORMAT),
            "year": F.year(pickup),
            "month": F.month(pickup),
        }
    )


def clean_trips(trips: DataFrame) -> DataFrame:
    """Bronze rows -> typed rows that fit their columns, with valid dates and their period, duplicates included."""
    return with_trip_period(with_valid_dates(typed_trips(fitting_trips(trips))))


def conform_trips(
    trips: DataFrame,
    order: Sequence[str] = LATEST_ARRIVAL,
    descending: bool = True,
    one_per_merge_key: bool = False,
) -> DataFrame:
    """Bronze rows -> Silver rows: typed, with valid dates, deduplicated, with their period.

    By default one row per trip and source file survives. ``one_per_merge_key`` also reduces
    a trip found in several files to one row. That equals deduplicating twice with the same
    order, since the first row of all is the first of the first rows per file, so it is done in
    one shuffle. The period follows from the pickup, a key, so it is added after that shuffle.
    """
    keys = MERGE_KEYS if one_per_merge_key else DEDUP_KEYS
    valid = with_valid_dates(typed_trips(fitting_trips(trips))).drop(*PARTITION_COLUMNS)
    return with_trip_period(first_per_key(valid, keys, order, descending))
