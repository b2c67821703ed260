"""Bronze -> Silver."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Row, SparkSession

from stratalake.config import NULLABLE_MERGE_KEYS, SUMMARY_KEYS, PipelineConfig
from stratalake.operators.changes import Changes
from stratalake.operators.clean import clean_trips, conform_trips, rejected_trips
from stratalake.operators.dedup import first_per_key
from stratalake.operators.metrics import StepCount
from stratalake.sinks.catalog import register_table
from stratalake.sinks.partitioned import write_partitioned
from stratalake.sinks.upsert import UpsertResult, upsert_first_per_key, upsert_table
from stratalake.sources.storage import table_exists
from stratalake.sources.tables import read_layer

log = logging.getLogger(__name__)


def upsert_silver(spark: SparkSession, bronze: DataFrame, config: PipelineConfig) -> UpsertResult:
    """Conform ``bronze`` rows, merge them into Silver, and register it."""
    order, descending = config.survivor_order, config.survivor_descending
    rows = clean_trips(bronze)
    if config.gold_state:
        # what is replaced has to be known as it was, which the one shuffle of the other form does not tell
        if config.on_conflict == "latest":
            unique = first_per_key(rows, config.silver.keys, order, descending)
        else:
            unique = conform_trips(bronze, order, descending)
        changes = Changes(config.silver_changes, (*SUMMARY_KEYS, "total_amount"))
        check = config.on_conflict != "latest"
        result = upsert_table(spark, unique, config.silver, NULLABLE_MERGE_KEYS, check, changes)
    elif config.on_conflict == "latest":
        result = upsert_first_per_key(spark, rows, config.silver, order, descending, NULLABLE_MERGE_KEYS)
    else:
        result = upsert_table(spark, conform_trips(bronze, order, descending), config.silver, NULLABLE_MERGE_KEYS)
    log.info("silver: merged %d rows into %s", result.source_rows, config.silver.path)
    if config.silver.qualified_name:
        register_table(spark, config.silver, rows.schema, result.partitions)
    return result


def run_silver(spark: SparkSession, config: PipelineConfig) -> tuple[list[StepCount], list[Row] | None]:
    """Merge all of Bronze into Silver. Returns the step counts and the partitions rewritten."""
    if not table_exists(spark, config.bronze.path):
        log.warning("silver: Bronze holds no rows yet")
        return [StepCount("silver", 0)], []
    bronze = read_layer(spark, config.bronze.path, config.bronze.partition_columns)
    result = upsert_silver(spark, bronze, config)
    steps = [StepCount("silver", result.source_rows)]
    if config.quarantine is not None:
        quarantine = config.quarantine
        written = write_partitioned(
            rejected_trips(bronze), quarantine.path, "overwrite", quarantine.partition_columns
        )
        log.info("silver: %d rows to quarantine %s", written["rows"], quarantine.path)
        steps.append(StepCount("quarantine", written["rows"]))
    return steps, result.partitions
