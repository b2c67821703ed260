"""Silver -> Gold."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession

from stratalake.config import NULLABLE_SUMMARY_KEYS, Layer, PipelineConfig
from stratalake.operators.changes import BEFORE
from stratalake.operators.metrics import StepCount
from stratalake.operators.summary import add_parts, monthly_summary, summary_of_parts, summary_parts
from stratalake.sinks import pending
from stratalake.sinks.catalog import register_table
from stratalake.sinks.partitioned import write_partitioned
from stratalake.sinks.pending import finish_pending
from stratalake.sinks.upsert import upsert_table
from stratalake.sources.storage import child_folders, path_exists, table_exists
from stratalake.sources.tables import in_partitions, partition_counts, read_files, read_layer

log = logging.getLogger(__name__)


def run_gold(spark: SparkSession, config: PipelineConfig, partitions: Sequence[Row] | None = None) -> StepCount:
    """Summarise Silver and merge the result into Gold.

    ``partitions`` limits the work to these Silver partitions. A group lies in one partition, so
    groups of the others are as they were. A group that vanished from Silver stays in Gold.
    """
    # A merge that died while it replaced partitions left some of them missing; its result is complete.
    finish_pending(spark, config.silver)
    if not table_exists(spark, config.silver.path):
        log.warning("gold: Silver holds no rows yet")
        return StepCount("gold", 0)
    if partitions is not None and not partitions:
        return StepCount("gold", 0)
    silver = read_layer(spark, config.silver.path, config.silver.partition_columns)
    if partitions is not None:
        silver = silver.filter(in_partitions(partitions, config.silver.partition_columns))
    summary = monthly_summary(silver, exact=config.exact_amounts)
    result = upsert_table(
        spark, summary, config.gold, nullable_keys=NULLABLE_SUMMARY_KEYS, check_source=False
    )
    log.info("gold: schema %s", summary.schema.simpleString())
    log.info("gold: merged %d groups into %s", result.source_rows, config.gold.path)
    if config.gold.qualified_name:
        register_table(spark, config.gold, summary.schema, result.partitions)
    return StepCount("gold", result.source_rows)


_CHANGE = "change string, year int, month int, payment_type string, total_amount double"


def _replace_partitions(spark: SparkSession, rows: DataFrame, layer: Layer, partitions: Sequence[Row]) -> int:
    """Put ``rows`` in the place of these partitions, which go if they get none."""
    written = write_partitioned(rows, pending.pending_rows(layer), "overwrite", layer.partition_columns)
    pending.note_obsolete(spark, layer, pending.files_of_partitions(spark, layer, partitions))
    pending.publish(spark, layer)
    return written["rows"]


def refresh_gold(spark: SparkSession, config: PipelineConfig) -> StepCount:
    """Bring Gold up to date from the changes of Silver alone: no Silver partition is read.

    The parts of Gold's totals are stored in ``config.gold_state``, one row per group as long as amounts are below 1e16. Rows that Silver replaced
    are taken away from them, and those it got are added; both are exact. Groups without a trip go. So Gold is what
    :func:`run_gold` makes of the same Silver from the start.

    New parts and the removal of the changes that are in them are published in one step, after Gold. A run that dies before it is
    repeated with the same changes, and one that dies within it is finished by the next, so each change counts once.
    """
    state, gold = config.gold_state, config.gold
    # a Silver merge or a refresh that was cut short delivers its changes, or takes them away, before they are listed
    finish_pending(spark, config.silver)
    finish_pending(spark, state)
    finish_pending(spark, gold)
    if not path_exists(spark, config.silver_changes):
        return StepCount("gold", 0)
    arrived = child_folders(spark, config.silver_changes)
    if not arrived:
        return StepCount("gold", 0)
    changes = spark.read.schema(_CHANGE).parquet(*arrived)
    delta = summary_parts(changes, config.exact_amounts == "binary", f"IF(change = '{BEFORE}', -1, 1)")
    touched = partition_counts(changes, state.partition_columns)
    known = read_files(spark, state.path, pending.files_of_partitions(spark, state, touched), delta.schema)
    write_partitioned(
        add_parts(known.unionByName(delta)), pending.pending_rows(state), "overwrite", state.partition_columns
    )
    parts = spark.read.schema(delta.schema).parquet(pending.pending_rows(state))
    summary = summary_of_parts(parts)
    rows = _replace_partitions(spark, summary, gold, touched)
    old = pending.files_of_partitions(spark, state, touched)
    pending.note_obsolete(spark, state, [*old, *arrived])
    pending.publish(spark, state)
    log.info("gold: %d groups of %d partitions from changes", rows, len(touched))
    if gold.qualified_name and table_exists(spark, gold.path):
        register_table(spark, gold, summary.schema, touched)
    return StepCount("gold", rows)
