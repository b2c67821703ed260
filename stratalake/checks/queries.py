"""One callable ``(spark, sf_dir) -> DataFrame`` per operator, over the whole tables.

Timestamps and dates come out as text, so that the comparison does not depend on time zones.
Queries about stored tables write into a fresh folder below ``spark.checkpoint.dir`` and read the
result back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake import functions as X
from stratalake import operators as O
from stratalake import sinks
from stratalake.checks.fixtures import RAW_SCHEMA, SURVIVOR_ORDER, label_of, trips_raw, write_damaged_dropzone, write_dropzone
from stratalake.config import (
    DATE_FORMAT,
    DEDUP_KEYS,
    MERGE_KEYS,
    NULLABLE_MERGE_KEYS,
    NULLABLE_SUMMARY_KEYS,
    PARTITION_COLUMNS,
    SUMMARY_KEYS,
    TIMESTAMP_FORMAT,
    Layer,
    PipelineConfig,
    standard_layers,
)
from stratalake.operators.changes import Changes
from stratalake.operators.clean import conform_trips
from stratalake.plans import refresh_gold, run_all, run_bronze, run_gold, run_silver
from stratalake.session import scratch_dir
from stratalake.sinks import append_or_create, columns_of, register_table, upsert_table, write_partitioned
from stratalake.sources import read_delimited, read_layer
from stratalake.streaming import (
    ingest_new_files,
    ingest_to_table,
    quarantine_new_rows,
    refresh_from_new_rows,
    upsert_distinct_rows,
    upsert_new_rows,
)

Query = Callable[[SparkSession, str], DataFrame]

RAW_COLUMNS = [f for f in RAW_SCHEMA.names if not f.startswith("l_")]


def _text(column: str) -> Column:
    return F.date_format(column, TIMESTAMP_FORMAT).alias(column)


def _silver_columns() -> list[Column | str]:
    return [
        "vendorid",
        _text("pickup_ts"),
        _text("dropoff_ts"),
        "passenger_count",
        "trip_distance",
        "payment_type",
        "total_amount",
        "ingestion_date",
        "year",
        "month",
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
    ]


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.typed_trips(trips_raw(spark, sf_dir))


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.with_valid_dates(_typed(spark, sf_dir))


def _conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform_trips(trips_raw(spark, sf_dir), SURVIVOR_ORDER, descending=False)


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carries through the dedup only what it and the summary use; the survivor order has no ties."""
    needed = _valid(spark, sf_dir).select(*DEDUP_KEYS, *SURVIVOR_ORDER, "payment_type")
    unique = O.first_per_key(needed, DEDUP_KEYS, SURVIVOR_ORDER)
    return O.monthly_summary(O.with_trip_period(unique))


def _config(spark: SparkSession, name: str, **changes) -> PipelineConfig:
    root = scratch_dir(spark, name)
    tag = uuid.uuid4().hex[:12]
    databases = tuple(f"{layer}_{tag}" for layer in ("bronze", "silver", "gold"))
    bronze, silver, gold = standard_layers(root, databases)
    return replace(
        PipelineConfig(
            dropzone=f"{root}/drop/*",
            bronze=bronze,
            silver=silver,
            gold=gold,
            schema=RAW_SCHEMA,
            survivor_order=SURVIVOR_ORDER,
            survivor_descending=False,
        ),
        **changes,
    )


def _drop(config: PipelineConfig) -> str:
    return config.dropzone.removesuffix("/*")


# Scans


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folders = write_dropzone(trips_raw(spark, sf_dir), scratch_dir(spark, "csv-scan"))
    return read_delimited(spark, folders, RAW_SCHEMA).select(*RAW_COLUMNS)


def csv_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with a bad amount, a bad id, a value less or a value more, as they are read and why they are rejected."""
    path = write_damaged_dropzone(trips_raw(spark, sf_dir), scratch_dir(spark, "csv-rescue"))
    raw = read_delimited(spark, path, RAW_SCHEMA, rescue=True)
    whole = O.fitting_trips(raw).withColumns({"rescued_record": F.lit(None).cast("string"), "reject_reason": F.lit(None)})
    bad = O.rejected_trips(raw).where("rescued_record is not null")
    return whole.unionByName(bad).select(*RAW_COLUMNS, "l_orderkey", "l_linenumber", "rescued_record", "reject_reason")


def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "table-scan")
    write_partitioned(O.with_pickup_date(trips_raw(spark, sf_dir)), path, "overwrite", PARTITION_COLUMNS)
    return read_layer(spark, path, PARTITION_COLUMNS).select(*RAW_COLUMNS, "source_file", "year", "month")


# Bronze columns


def bronze_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    folders = write_dropzone(trips_raw(spark, sf_dir), scratch_dir(spark, "bronze-enrich"))
    rows = O.with_pickup_date(O.with_lineage(read_delimited(spark, folders, RAW_SCHEMA)))
    return rows.select(
        *RAW_COLUMNS,
        label_of().alias("source_label"),
        F.date_format("pickup_date", DATE_FORMAT).alias("pickup_date"),
        "year",
        "month",
    )


def lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    folders = write_dropzone(trips_raw(spark, sf_dir), scratch_dir(spark, "lineage"))
    rows = O.with_lineage(read_delimited(spark, folders, RAW_SCHEMA))
    shape = "^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"
    return rows.select(
        "vendorid",
        "l_orderkey",
        "l_linenumber",
        label_of().alias("source_label"),
        F.col("ingestion_timestamp").rlike(shape).cast("int").alias("has_file_time"),
    )


# Scalar functions


def parse_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(spark, sf_dir).select(
        "tpep_pickup_datetime", "tpep_dropoff_datetime", _text("pickup_ts"), _text("dropoff_ts")
    )


def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = O.with_pickup_date(trips_raw(spark, sf_dir))
    stamp = X.parse_timestamp("tpep_dropoff_datetime")
    return rows.select(
        "tpep_pickup_datetime",
        F.date_format("pickup_date", DATE_FORMAT).alias("pickup_date"),
        "year",
        "month",
        F.year(stamp).alias("dropoff_year"),
        F.month(stamp).alias("dropoff_month"),
    )


def format_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = O.with_trip_period(_typed(spark, sf_dir))
    return rows.select("tpep_pickup_datetime", _text("pickup_ts"), "ingestion_date")


def cast_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = trips_raw(spark, sf_dir)
    return raw.select(
        F.col("passenger_count").alias("passenger_text"),
        F.col("trip_distance").alias("distance_text"),
        X.to_int("passenger_count").alias("passenger_count"),
        X.to_double("trip_distance").alias("trip_distance"),
        X.to_int(F.concat(F.lit("-"), F.col("l_linenumber").cast("string"), F.lit(".9"))).alias("truncated"),
        X.exact_amount("total_amount").cast("double").alias("amount"),
    )


# Filters


def valid_dates_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _valid(spark, sf_dir).select("vendorid", _text("pickup_ts"), _text("dropoff_ts"), "source_file", "l_orderkey")


def quarantine_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.rejected_trips(trips_raw(spark, sf_dir)).select(*RAW_COLUMNS, "source_file", "reject_reason")


# Duplicates


def dedup_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = O.any_per_key(_valid(spark, sf_dir), DEDUP_KEYS)
    return rows.select("vendorid", _text("pickup_ts"), _text("dropoff_ts"), "source_file")


def dedup_deterministic(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = O.with_trip_period(O.first_per_key(_valid(spark, sf_dir), DEDUP_KEYS, SURVIVOR_ORDER))
    return rows.select(*_silver_columns(), "source_file")


def merge_key_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = O.key_conflicts(_conformed(spark, sf_dir), MERGE_KEYS, NULLABLE_MERGE_KEYS)
    return rows.select("vendorid", _text("pickup_ts"), _text("dropoff_ts"), "source_rows")


# Silver


def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conform_trips(trips_raw(spark, sf_dir), SURVIVOR_ORDER, descending=False, one_per_merge_key=True)
    return rows.select(*_silver_columns(), "source_file")


def _target_and_source(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = _conformed(spark, sf_dir)
    return rows.filter("source_file = 'F'"), rows.filter("source_file = 'O'")


def silver_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _target_and_source(spark, sf_dir)
    layer = Layer(scratch_dir(spark, "silver-upsert"), keys=MERGE_KEYS)
    upsert_table(spark, target, layer, NULLABLE_MERGE_KEYS)
    upsert_table(spark, source, layer, NULLABLE_MERGE_KEYS)
    return read_layer(spark, layer.path, PARTITION_COLUMNS).select(*_silver_columns(), "source_file")


def _corrections(trips: DataFrame) -> DataFrame:
    """About one trip in 350, all over the table, with another amount; and as many trips of new vendors."""
    some = trips.filter("l_linenumber = 7 and trip_distance = 50").withColumn("total_amount", F.col("total_amount") + 1)
    return some.unionByName(some.withColumn("vendorid", F.col("vendorid") + 1_000_000))


def upsert_touched_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections merged into a table of several files a month; files without a corrected trip stay as they are."""
    trips = conform_trips(trips_raw(spark, sf_dir), SURVIVOR_ORDER, descending=False, one_per_merge_key=True)
    layer = Layer(scratch_dir(spark, "upsert-files"), keys=MERGE_KEYS)
    for part in range(4):
        some = trips.filter(F.pmod("vendorid", F.lit(4)) == part)
        write_partitioned(some, layer.path, "append" if part else "overwrite", PARTITION_COLUMNS)
    stored = read_layer(spark, layer.path, PARTITION_COLUMNS)
    upsert_table(spark, _corrections(stored), layer, NULLABLE_MERGE_KEYS)
    return read_layer(spark, layer.path, PARTITION_COLUMNS).select(*_silver_columns(), "source_file")


def upsert_by_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two lots and corrections merged into a catalog table whose partitions move to each merge's folder."""
    silver = _config(spark, "upsert-location").silver
    for source in _target_and_source(spark, sf_dir):
        sinks.upsert_by_location(spark, source, silver, NULLABLE_MERGE_KEYS)
    corrections = _corrections(spark.table(silver.qualified_name))
    sinks.upsert_by_location(spark, corrections, silver, NULLABLE_MERGE_KEYS)
    return spark.table(silver.qualified_name).select(*_silver_columns(), "source_file")


def bucketed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two lots merged bucket by bucket; the table is not shuffled."""
    silver = _config(spark, "bucketed").silver
    for source in _target_and_source(spark, sf_dir):
        sinks.upsert_by_location(spark, source, silver, NULLABLE_MERGE_KEYS, buckets=4)
    return spark.table(silver.qualified_name).select(*_silver_columns(), "source_file")


def merge_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _target_and_source(spark, sf_dir)
    return O.merge_frames(target, source, MERGE_KEYS).select(*_silver_columns(), "source_file")


def merge_matched_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _target_and_source(spark, sf_dir)
    return O.updated_rows(target, source, MERGE_KEYS).select(*_silver_columns(), "source_file")


def merge_not_matched_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _target_and_source(spark, sf_dir)
    return O.inserted_rows(target, source, MERGE_KEYS).select(*_silver_columns(), "source_file")


def merge_target_retained(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _target_and_source(spark, sf_dir)
    return O.retained_rows(target, source, MERGE_KEYS).select(*_silver_columns(), "source_file")


# Gold


def gold_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(spark, sf_dir)


def gold_exact_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thirds of the amounts, which are no decimals, summed as the doubles that they are."""
    trips = _conformed(spark, sf_dir).withColumn("total_amount", F.col("total_amount") / 3)
    return O.monthly_summary(trips, exact="binary")


def gold_delta_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two lots of trips, and corrections that move trips to another payment type; Gold takes in the changes of each."""
    config = _config(spark, "gold-delta")
    config = replace(config, gold_state=Layer(f"{config.gold.path}-state"))
    changes = Changes(config.silver_changes, (*SUMMARY_KEYS, "total_amount"))
    trips = _conformed(spark, sf_dir)

    def refresh(rows: DataFrame) -> None:
        upsert_table(spark, rows, config.silver, NULLABLE_MERGE_KEYS, changes=changes)
        refresh_gold(spark, config)

    for lot in ("F", "O"):
        refresh(trips.filter(F.col("source_file") == lot))
    moved = _corrections(read_layer(spark, config.silver.path, PARTITION_COLUMNS))
    refresh(moved.withColumn("payment_type", F.lit("M")))
    return spark.table(config.gold.qualified_name)


def preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = _summary(spark, sf_dir).filter(F.col("payment_type").isNotNull())
    return O.preview(named, SUMMARY_KEYS)


def _gold_merged_onto_itself(spark: SparkSession, sf_dir: str, nullable_keys: tuple[str, ...]) -> DataFrame:
    layer = Layer(scratch_dir(spark, "gold-upsert"), keys=SUMMARY_KEYS)
    upsert_table(spark, _summary(spark, sf_dir), layer, nullable_keys)
    upsert_table(spark, read_layer(spark, layer.path, PARTITION_COLUMNS), layer, nullable_keys)
    return read_layer(spark, layer.path, PARTITION_COLUMNS)


def gold_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged onto itself with ``=``: groups without payment type are inserted once more."""
    return _gold_merged_onto_itself(spark, sf_dir, ())


def gold_upsert_nullsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold_merged_onto_itself(spark, sf_dir, NULLABLE_SUMMARY_KEYS)


# Sinks and catalog


def partitioned_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "overwrite")
    for _ in range(2):
        write_partitioned(_conformed(spark, sf_dir), path, "overwrite", PARTITION_COLUMNS)
    return read_layer(spark, path, PARTITION_COLUMNS).select(*_silver_columns(), "source_file")


def partitioned_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    layer = Layer(scratch_dir(spark, "append"))
    rows = O.with_pickup_date(trips_raw(spark, sf_dir))
    for _ in range(2):
        append_or_create(spark, rows, layer)
    return read_layer(spark, layer.path, PARTITION_COLUMNS).select(*RAW_COLUMNS, "source_file", "year", "month")


def append_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registered table whose second lot has one more column and a wider one."""
    layer = _config(spark, "new-column").bronze
    rows = O.with_pickup_date(trips_raw(spark, sf_dir)).select(*RAW_COLUMNS, "source_file", "l_linenumber", "year", "month")
    later = rows.withColumns({"l_linenumber": F.col("l_linenumber").cast("long"), "fare_class": F.upper("payment_type")})
    for lot, part in (("F", rows), ("O", later)):
        some = part.filter(F.col("source_file") == lot)
        append_or_create(spark, some, layer, evolve=True)
        register_table(spark, layer, some.schema)
    return spark.table(layer.qualified_name)


def upsert_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections with one more column, and without one that the table has, merged into it."""
    target, source = _target_and_source(spark, sf_dir)
    layer = Layer(scratch_dir(spark, "upsert-column"), keys=MERGE_KEYS)
    upsert_table(spark, target, layer, NULLABLE_MERGE_KEYS)
    source = source.withColumns({"l_linenumber": F.col("l_linenumber").cast("long"), "checked": F.lit(True)}).drop("l_partkey")
    upsert_table(spark, source, layer, NULLABLE_MERGE_KEYS, evolve=True)
    return read_layer(spark, layer.path, PARTITION_COLUMNS).select(*_silver_columns(), "source_file", "checked")


def _registered_silver(spark: SparkSession, sf_dir: str, name: str) -> Layer:
    silver = _config(spark, name).silver
    rows = _conformed(spark, sf_dir)
    write_partitioned(rows, silver.path, "overwrite", PARTITION_COLUMNS)
    for _ in range(2):
        register_table(spark, silver, rows.schema)
    return silver


def register_external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.table(_registered_silver(spark, sf_dir, "register").qualified_name)
    return table.select(*_silver_columns(), "source_file")


def catalog_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of a registered table as the catalog lists them, with the table's row count."""
    table = spark.table(_registered_silver(spark, sf_dir, "catalog").qualified_name)
    listed = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("column_type"),
            F.lit(int(is_partition)).alias("is_partition"),
        )
        for i, (name, kind, is_partition) in enumerate(columns_of(table.schema, PARTITION_COLUMNS), start=1)
    ]
    return table.agg(F.count(F.lit(1)).alias("table_rows")).select("table_rows", F.inline(F.array(*listed)))


# Layer runs


def row_count_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _config(spark, "metrics")
    config = replace(config, quarantine=Layer(f"{_drop(config)}-rejected"))
    write_dropzone(trips_raw(spark, sf_dir), _drop(config))
    return O.step_report(spark, run_all(spark, config))


def bronze_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _config(spark, "bronze-run")
    write_dropzone(trips_raw(spark, sf_dir), _drop(config))
    run_bronze(spark, config)
    return spark.table(config.bronze.qualified_name).select(
        *RAW_COLUMNS,
        label_of().alias("source_label"),
        F.date_format("pickup_date", DATE_FORMAT).alias("pickup_date"),
        "year",
        "month",
    )


def silver_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run twice: the second run must change nothing."""
    config = _config(spark, "silver-run")
    write_dropzone(trips_raw(spark, sf_dir), _drop(config))
    run_bronze(spark, config)
    for _ in range(2):
        run_silver(spark, config)
    return spark.table(config.silver.qualified_name).select(*_silver_columns(), label_of().alias("source_label"))


def gold_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run twice over a stored Silver table: the second run must change nothing."""
    config = _config(spark, "gold-run")
    write_partitioned(_conformed(spark, sf_dir), config.silver.path, "overwrite", PARTITION_COLUMNS)
    for _ in range(2):
        run_gold(spark, config)
    return spark.table(config.gold.qualified_name)


def medallion_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _config(spark, "medallion")
    write_dropzone(trips_raw(spark, sf_dir), _drop(config))
    run_all(spark, config)
    return spark.table(config.gold.qualified_name)


# Incremental runs


def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files arrive in two lots, and the third run finds nothing new."""
    config = _config(spark, "ingest")
    trips = trips_raw(spark, sf_dir)
    for labels in (("F",), ("O",), ()):
        write_dropzone(trips, _drop(config), labels)
        ingest_new_files(spark, config, f"{_drop(config)}-progress")
    return read_layer(spark, config.bronze.path, PARTITION_COLUMNS).select(
        *RAW_COLUMNS, label_of().alias("source_label"), "year", "month"
    )


def incremental_bronze_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files arrive in two lots; each batch is a registered folder, read through the catalog."""
    config = _config(spark, "bronze-table")
    trips = trips_raw(spark, sf_dir)
    for labels in (("F",), ("O",), ()):
        write_dropzone(trips, _drop(config), labels)
        ingest_to_table(spark, config, f"{_drop(config)}-progress")
    return spark.table(config.bronze.qualified_name).select(
        *RAW_COLUMNS, label_of().alias("source_label"), "batch", "year", "month"
    )


def incremental_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per step of incremental runs over two lots, summed over the runs."""
    config = _config(spark, "incremental-metrics")
    config = replace(config, quarantine=Layer(f"{_drop(config)}-rejected"))
    trips, steps = trips_raw(spark, sf_dir), []
    for labels in (("F",), ("O",)):
        write_dropzone(trips, _drop(config), labels)
        steps += ingest_new_files(spark, config, f"{_drop(config)}-ingested")
        steps += refresh_from_new_rows(spark, config, f"{_drop(config)}-merged")
        steps += quarantine_new_rows(spark, config, f"{_drop(config)}-quarantined")
    return O.step_report(spark, steps).groupBy("step").agg(F.sum("rows").alias("rows"))


def _two_lots(spark: SparkSession, sf_dir: str, name: str, step: Callable) -> PipelineConfig:
    config = _config(spark, name)
    trips = trips_raw(spark, sf_dir)
    for labels in (("F",), ("O",)):
        write_dropzone(trips, _drop(config), labels)
        ingest_new_files(spark, config, f"{_drop(config)}-ingested")
        step(spark, config, f"{_drop(config)}-merged")
    return config


def incremental_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three lots, the third a second delivery of the first; trips seen before are not merged again, over restarts."""
    config = _config(spark, "incremental-dedup")
    trips, merged = trips_raw(spark, sf_dir), []
    for labels in (("F",), ("O",), ("F",)):
        write_dropzone(trips, _drop(config), labels)
        ingest_new_files(spark, config, f"{_drop(config)}-ingested")
        late = Layer(f"{_drop(config)}-late")
        merged += upsert_distinct_rows(spark, config, f"{_drop(config)}-merged", "3650 days", late)
    stored = read_layer(spark, config.silver.path, PARTITION_COLUMNS)
    total = {step: sum(m.rows for m in merged if m.step == step) for step in ("silver", "late")}
    return stored.select(
        "vendorid",
        _text("pickup_ts"),
        _text("dropoff_ts"),
        F.lit(total["silver"]).cast("long").alias("rows_merged"),
        F.lit(total["late"]).cast("long").alias("rows_late"),
    )


def incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _two_lots(spark, sf_dir, "incremental-upsert", upsert_new_rows)
    return read_layer(spark, config.silver.path, PARTITION_COLUMNS).select(
        *_silver_columns(), label_of().alias("source_label")
    )


def incremental_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _two_lots(spark, sf_dir, "incremental-refresh", refresh_from_new_rows)
    return spark.table(config.gold.qualified_name)


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        gold_aggregate,
        csv_scan,
        csv_rescue,
        table_scan,
        bronze_enrich,
        lineage_columns,
        parse_timestamps,
        date_parts,
        format_timestamps,
        cast_numeric,
        valid_dates_filter,
        quarantine_rejects,
        dedup_subset,
        dedup_deterministic,
        merge_key_conflicts,
        silver_clean,
        silver_upsert,
        upsert_touched_files,
        upsert_by_location,
        bucketed_upsert,
        merge_frames,
        merge_matched_update,
        merge_not_matched_insert,
        merge_target_retained,
        gold_upsert,
        gold_upsert_nullsafe,
        gold_exact_sum,
        gold_delta_refresh,
        preview_limit,
        partitioned_overwrite,
        partitioned_append,
        append_new_column,
        upsert_new_column,
        register_external_table,
        catalog_schema,
        row_count_metric,
        bronze_run,
        silver_run,
        gold_run,
        medallion_end_to_end,
        incremental_ingest,
        incremental_bronze_table,
        incremental_metrics,
        incremental_dedup,
        incremental_upsert,
        incremental_refresh,
    )
}
