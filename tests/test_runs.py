import shutil
from dataclasses import replace
from pathlib import Path

import pytest
from conftest import rows_of

from stratalake.__main__ import config_from, parse
from stratalake.config import Layer, PipelineConfig, standard_layers
from stratalake.operators import DuplicateKeyError, StepCount, step_report
from stratalake.plans import EmptyInputError, run_all, run_bronze, run_gold, run_silver
from stratalake.session import fit_shuffles, shuffle_partitions_for
from stratalake.sinks import upsert, write_partitioned
from stratalake.sources import mark, read_layer, size_in_bytes
from stratalake.streaming import ingest_new_files, quarantine_new_rows, refresh_from_new_rows, upsert_new_rows

HEADER = "VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,payment_type,total_amount,tip"
JANUARY = [
    "1,2020-01-01 00:00:00,2020-01-01 00:10:00,1.0,2.5,1,10.50,1",
    "1,2020-01-01 00:00:00,2020-01-01 00:10:00,1.0,2.5,1,10.50,1",
    "2,2020-01-05 00:00:00,2020-01-05 00:10:00,x,2.5,,7.25,0",
    ",2020-01-06 00:00:00,2020-01-06 00:10:00,1,2.5,2,1.00,0",
    "3,nonsense,2020-01-05 00:10:00,1,2.5,2,99.00,0",
]
CORRECTED = [
    "1,2020-01-01 00:00:00,2020-01-01 00:10:00,4,2.5,1,12.00,1",
    ",2020-01-06 00:00:00,2020-01-06 00:10:00,1,2.5,2,2.00,0",
    "9,2020-02-01 00:00:00,2020-02-01 00:10:00,1,2.5,2,3.00,0",
]
GOLD = sorted([(2020, 1, "1", 1, 10.5), (2020, 1, None, 1, 7.25), (2020, 1, "2", 1, 1.0)], key=repr)
GOLD_CORRECTED = sorted(
    [(2020, 1, "1", 1, 12.0), (2020, 1, None, 1, 7.25), (2020, 1, "2", 1, 2.0), (2020, 2, "2", 1, 3.0)], key=repr
)


def drop(folder, name, lines, mtime):
    import os

    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    os.utime(path, (mtime, mtime))


@pytest.fixture
def config(tmp_path):
    name = tmp_path.name
    bronze, silver, gold = standard_layers(str(tmp_path), tuple(f"{x}_{name}" for x in ("b", "s", "g")))
    drop(tmp_path / "drop", "january.csv", JANUARY, 1_700_000_000)
    return PipelineConfig(dropzone=str(tmp_path / "drop"), bronze=bronze, silver=silver, gold=gold)


def gold_of(spark, config):
    columns = ["year", "month", "payment_type", "total_trips", "total_amount_collected"]
    return rows_of(read_layer(spark, config.gold.path, ("year", "month")).select(columns))


def test_all_layers_and_their_counts(spark, config, tmp_path):
    config = replace(config, quarantine=Layer(str(tmp_path / "rejected")))
    steps = run_all(spark, config)
    assert steps == [StepCount("bronze", 5), StepCount("silver", 3), StepCount("quarantine", 1), StepCount("gold", 3)]
    assert rows_of(step_report(spark, steps)) == [("bronze", 5), ("gold", 3), ("quarantine", 1), ("silver", 3)]
    assert gold_of(spark, config) == GOLD
    for layer in (config.bronze, config.silver, config.gold):
        assert spark.table(layer.qualified_name).count() == read_layer(spark, layer.path, ("year", "month")).count()
    silver = read_layer(spark, config.silver.path, ("year", "month"))
    assert {"tip", "source_file", "ingestion_timestamp", "pickup_date", "ingestion_date"} <= set(silver.columns)
    assert silver.filter("vendorid = 2").first().passenger_count is None


def test_inferred_schema_runs_through_all_layers(spark, config):
    steps = run_all(spark, replace(config, infer_schema=True))
    assert [s.rows for s in steps] == [5, 3, 3]
    bronze = read_layer(spark, config.bronze.path, ("year", "month"))
    assert dict(bronze.dtypes)["payment_type"] == "int"
    assert all("january.csv" in r.source_file for r in bronze.collect())
    with pytest.raises(ValueError, match="differ from the table"):
        run_bronze(spark, config)


def test_rerun_doubles_bronze_only(spark, config):
    run_all(spark, config)
    run_all(spark, config)
    assert read_layer(spark, config.bronze.path, ("year", "month")).count() == 10
    assert read_layer(spark, config.silver.path, ("year", "month")).count() == 3
    assert gold_of(spark, config) == GOLD


def test_rerun_breaks_ties_the_same_way(spark, config, tmp_path):
    ties = [
        f"{v},2020-01-0{d}{t},2020-01-02 00:00:00,{p},{m}.5,{p},{a}.25,{m}"
        for v in (1, 2)
        for d in (1, 2)
        for t in ("", " 00:00:00")
        for p, m, a in ((1, 9, 5), (2, 8, 6), (3, 7, 4))
    ]
    drop(tmp_path / "drop", "january.csv", ties, 1_700_000_000)
    run_all(spark, config)
    columns = sorted(read_layer(spark, config.silver.path, ("year", "month")).columns)
    silver = lambda: rows_of(read_layer(spark, config.silver.path, ("year", "month")).select(columns))
    once = silver()
    assert len(once) == 4
    run_all(spark, config)
    assert silver() == once


def test_incremental_run_registers_and_quarantines(spark, config, tmp_path):
    config = replace(config, quarantine=Layer(str(tmp_path / "rejected")))
    for lot in (JANUARY, CORRECTED, JANUARY[-1:]):
        drop(tmp_path / "drop", f"{len(lot)}.csv", lot, 1_700_000_000 + len(lot))
        ingest_new_files(spark, config, str(tmp_path / "p1"))
        refresh_from_new_rows(spark, config, str(tmp_path / "p2"))
        quarantine_new_rows(spark, config, str(tmp_path / "p3"))
    assert spark.table(config.silver.qualified_name).count() == 4
    assert rows_of(spark.table(config.gold.qualified_name)) != []
    assert read_layer(spark, config.quarantine.path, ("year", "month")).count() == 3


def test_newest_file_wins(spark, config, tmp_path):
    run_all(spark, config)
    drop(tmp_path / "drop", "a_correction.csv", CORRECTED, 1_700_000_100)
    run_all(spark, config)
    assert gold_of(spark, config) == GOLD_CORRECTED


def test_trip_in_two_files_fails_where_told_so(spark, config, tmp_path):
    drop(tmp_path / "drop", "a_correction.csv", CORRECTED, 1_700_000_100)
    run_bronze(spark, config)
    with pytest.raises(DuplicateKeyError):
        run_silver(spark, replace(config, on_conflict="fail"))
    steps, touched = run_silver(spark, config)
    assert steps[0].rows == 4 and touched is None


def test_gold_of_some_partitions_leaves_the_others(spark, config, tmp_path):
    run_all(spark, config)
    before = {p.name for p in Path(config.gold.path, "year=2020", "month=1").glob("*.parquet")}
    drop(tmp_path / "drop2", "february.csv", CORRECTED[2:], 1_700_000_200)
    later = replace(config, dropzone=str(tmp_path / "drop2"))
    run_bronze(spark, later)
    bronze = read_layer(spark, config.bronze.path, ("year", "month")).filter("month = 2")
    from stratalake.plans.silver import upsert_silver

    touched = upsert_silver(spark, bronze, later).partitions
    assert [(p.year, p.month) for p in touched] == [(2020, 2)]
    assert run_gold(spark, later, touched).rows == 1
    assert {p.name for p in Path(config.gold.path, "year=2020", "month=1").glob("*.parquet")} == before
    assert gold_of(spark, config) == sorted([*GOLD, (2020, 2, "2", 1, 3.0)], key=repr)


def test_gold_group_that_left_silver_stays(spark, config):
    run_all(spark, config)
    silver = read_layer(spark, config.silver.path, ("year", "month")).filter("payment_type = '1'")
    only = replace(config, silver=replace(config.silver, path=config.silver.path + "_only"))
    write_partitioned(silver, only.silver.path, "overwrite", ("year", "month"))
    run_gold(spark, replace(only, gold=replace(only.gold, table=None)))
    assert gold_of(spark, config) == GOLD


def test_failed_batch_is_run_again(spark, config, tmp_path, monkeypatch):
    from stratalake.streaming import refresh

    ingest_new_files(spark, config, str(tmp_path / "p1"))
    real = refresh.run_gold

    def dies(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(refresh, "run_gold", dies)
    with pytest.raises(Exception):
        refresh_from_new_rows(spark, config, str(tmp_path / "p2"))
    monkeypatch.setattr(refresh, "run_gold", real)
    refresh_from_new_rows(spark, config, str(tmp_path / "p2"))
    assert gold_of(spark, config) == GOLD


def test_unparsable_pickup_goes_to_the_null_partition(spark, config):
    run_bronze(spark, config)
    bronze = read_layer(spark, config.bronze.path, ("year", "month"))
    assert [r.total_amount for r in bronze.filter("year IS NULL").collect()] == [99.0]
    assert Path(config.bronze.path, "year=__HIVE_DEFAULT_PARTITION__", "month=__HIVE_DEFAULT_PARTITION__").exists()


def test_empty_drop_zone(spark, config, tmp_path):
    drop(tmp_path / "none", "empty.csv", [], 1_700_000_000)
    empty = replace(config, dropzone=str(tmp_path / "none"))
    with pytest.raises(EmptyInputError):
        run_bronze(spark, replace(empty, on_empty="fail"))
    assert [s.rows for s in run_all(spark, empty)] == [0, 0, 0]
    assert run_all(spark, config)[-1].rows == 3


def test_failing_step_stops_the_chain(spark, config):
    with pytest.raises(Exception):
        run_all(spark, replace(config, dropzone=config.dropzone + "/nothing"))
    assert not Path(config.silver.path).exists()


def test_unknown_policies_are_refused(config):
    with pytest.raises(ValueError):
        replace(config, on_conflict="maybe")
    with pytest.raises(ValueError):
        replace(config, on_empty="maybe")


def test_each_file_is_ingested_once(spark, config, tmp_path):
    progress = str(tmp_path / "progress")
    ingest_new_files(spark, config, progress)
    ingest_new_files(spark, config, progress)
    count = lambda: read_layer(spark, config.bronze.path, ("year", "month")).count()
    assert count() == 5
    drop(tmp_path / "drop", "later.csv", CORRECTED, 1_700_000_100)
    ingest_new_files(spark, config, progress, max_files_per_batch=1)
    assert count() == 8


def test_new_file_with_an_old_date_is_ingested_too(spark, config, tmp_path):
    progress = str(tmp_path / "progress")
    ingest_new_files(spark, config, progress)
    drop(tmp_path / "drop", "old.csv", CORRECTED, 1_600_000_000)
    ingest_new_files(spark, config, progress)
    assert read_layer(spark, config.bronze.path, ("year", "month")).count() == 8


def test_incremental_refresh_equals_one_batch(spark, config, tmp_path):
    for lot in (JANUARY, CORRECTED):
        drop(tmp_path / "drop", f"{len(lot)}.csv", lot, 1_700_000_000 + len(lot))
        ingest_new_files(spark, config, str(tmp_path / "p1"))
        for _ in range(2):
            refresh_from_new_rows(spark, config, str(tmp_path / "p2"))
    assert gold_of(spark, config) == GOLD_CORRECTED


def test_incremental_upsert_before_any_bronze_does_nothing(spark, config, tmp_path):
    upsert_new_rows(spark, config, str(tmp_path / "p"))
    assert not Path(config.silver.path).exists()


def test_batch_table_is_not_streamed_into(spark, config, tmp_path):
    run_bronze(spark, config)
    with pytest.raises(ValueError, match="batch loads"):
        ingest_new_files(spark, config, str(tmp_path / "p"))
    with pytest.raises(ValueError, match="one directory"):
        ingest_new_files(spark, replace(config, dropzone=["a", "b"]), str(tmp_path / "p"))
    with pytest.raises(ValueError, match="fixed schema"):
        ingest_new_files(spark, replace(config, infer_schema=True), str(tmp_path / "p"))


def test_command_line():
    args = parse(["all", "--root", "/data/", "--dropzone", "/raw", "--quarantine", "/bad", "--on-conflict", "fail"])
    config = config_from(args)
    assert config.silver.path == "/data/silver/trips" and config.on_conflict == "fail"
    assert config.quarantine.path == "/bad" and config.gold.qualified_name == "`gold`.`trips`"
    for wrong in (["bronze", "--root", "/x"], ["export", "--root", "/x"], ["nothing", "--root", "/x"]):
        with pytest.raises(SystemExit):
            parse(wrong)


def test_shuffle_partitions_follow_the_input(spark, tmp_path):
    assert [shuffle_partitions_for(n) for n in (0, 10**9, 10**12, 10**14)] == [200, 200, 1863, 50_000]
    for name in ("a", "b"):
        drop(tmp_path / name, "x.csv", [], 1)
    assert size_in_bytes(spark, str(tmp_path / "*")) == 2 * (len(HEADER) + 1)
    assert size_in_bytes(spark, str(tmp_path / "missing")) == 0
    fit_shuffles(spark, 10**14)  # the tests' session was started with a number of its own
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_gold_finishes_what_a_dead_silver_merge_left(spark, config):
    run_all(spark, config)
    silver = config.silver
    rows = read_layer(spark, silver.path, silver.partition_columns)
    write_partitioned(rows, upsert._pending_rows(silver), "overwrite", silver.partition_columns)
    mark(spark, upsert._pending_mark(silver))
    folder = Path(silver.path, "year=2020")
    assert folder.exists()
    shutil.rmtree(folder)
    run_gold(spark, config)
    assert gold_of(spark, config) == GOLD
