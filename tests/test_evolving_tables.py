"""Tables that get new or wider columns, tables in buckets, and streams that remember what was delivered."""

import re
from dataclasses import replace
from pathlib import Path

import pytest
from conftest import rows_of
from pyspark.sql import types as T

from stratalake.config import Layer, PipelineConfig, standard_layers
from stratalake.operators import SchemaConflictError, StepCount, aligned, merge_frames, reconcile
from stratalake.sinks import append_or_create, register_table, upsert_by_location, upsert_table, versions
from stratalake.sources import read_layer
from stratalake.streaming import distinct, ingest_new_files, upsert_distinct_rows

PARTS = ("year",)


def schema(text):
    return T._parse_datatype_string(text)


@pytest.mark.parametrize(
    ("stored", "given", "want", "added", "widened"),
    [
        ("a int, year int", "a int, year int", "a int, year int", (), ()),
        ("a int, year int", "a bigint, year int", "a bigint, year int", (), ("a",)),
        ("a bigint, year int", "a smallint, year int", "a bigint, year int", (), ()),
        ("a tinyint, b float, year int", "b double, a double, year int", "a double, b double, year int", (), ("a", "b")),
        ("a int, year int", "z string, A int, y date, year int", "a int, z string, y date, year int", ("z", "y"), ()),
        ("a decimal(10,2), year int", "a decimal(12,4), year int", "a decimal(12,4), year int", (), ("a",)),
        ("a int, b string, year int", "a int, year int", "a int, b string, year int", (), ()),
    ],
)
def test_reconciled_columns(spark, stored, given, want, added, widened):
    got = reconcile(schema(stored), schema(given), PARTS)
    assert (got.schema.simpleString(), got.added, got.widened) == (schema(want).simpleString(), added, widened)


@pytest.mark.parametrize(
    ("stored", "given"),
    [
        ("a string, year int", "a int, year int"),
        ("a bigint, year int", "a double, year int"),
        ("a decimal(10,2), year int", "a decimal(9,4), year int"),
        ("a int, year int", "a int, year bigint"),
        ("a timestamp, year int", "a date, year int"),
    ],
)
def test_types_that_do_not_go_together_are_refused(spark, stored, given):
    with pytest.raises(SchemaConflictError):
        reconcile(schema(stored), schema(given), PARTS)


def test_aligned_rows(spark):
    rows = spark.createDataFrame([(1, "x")], "B int, extra string")
    got = aligned(rows, schema("a string, b bigint"))
    assert got.columns == ["a", "b"] and got.collect() == [(None, 1)]


@pytest.fixture
def table(spark, tmp_path):
    layer = Layer(str(tmp_path / "t"), f"db_{tmp_path.name}", "t", str(tmp_path / "db"), PARTS, ("k",))
    yield layer
    spark.sql(f"DROP DATABASE IF EXISTS `{layer.database}` CASCADE")


def test_append_adds_and_widens(spark, table):
    append_or_create(spark, spark.createDataFrame([(1, 1.5, 2020)], "k int, f float, year int"), table)
    register_table(spark, table, schema("k int, f float, year int"))
    later = spark.createDataFrame([(2**40, 0.1, "new", 2020), (3, 0.2, "x", 2021)], "k bigint, f double, n string, year int")
    with pytest.raises(ValueError, match="differ from the table"):
        append_or_create(spark, later, table)
    append_or_create(spark, later, table, evolve=True)
    register_table(spark, table, later.schema)
    earlier = spark.createDataFrame([(4, 2020)], "k smallint, year int")
    append_or_create(spark, earlier, table, evolve=True)
    want = sorted([(1, 1.5, None, 2020), (2**40, 0.1, "new", 2020), (3, 0.2, "x", 2021), (4, None, None, 2020)], key=repr)
    by_path, by_name = read_layer(spark, table.path, PARTS), spark.table(table.qualified_name)
    for got in (by_path, by_name):
        assert rows_of(got.select("k", "f", "n", "year")) == want
        assert got.schema.simpleString() == "struct<k:bigint,f:double,n:string,year:int>"
    # filters are evaluated on files of both kinds
    assert by_path.where("k = 1 and f > 1").count() == 1 and by_name.where("n is null").count() == 2


def test_added_column_keeps_the_catalog_entry(spark, table):
    append_or_create(spark, spark.createDataFrame([(1, 2020)], "k int, year int"), table)
    register_table(spark, table, schema("k int, year int"))
    spark.sql(f"ALTER TABLE {table.qualified_name} SET TBLPROPERTIES ('kept' = 'yes')")
    append_or_create(spark, spark.createDataFrame([(2, "n", 2020)], "k int, n string, year int"), table, evolve=True)
    shown = {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {table.qualified_name}").collect()}
    assert shown["kept"] == "yes" and spark.table(table.qualified_name).columns == ["k", "n", "year"]


def test_conflict_leaves_the_table_as_it_is(spark, table):
    append_or_create(spark, spark.createDataFrame([(1, "a", 2020)], "k int, v string, year int"), table)
    with pytest.raises(SchemaConflictError, match="'v'"):
        append_or_create(spark, spark.createDataFrame([(1, 5, 2020)], "k int, v int, year int"), table, evolve=True)
    assert rows_of(read_layer(spark, table.path, PARTS)) == [(1, "a", 2020)]


def test_merge_adds_and_widens(spark, table):
    upsert_table(spark, spark.createDataFrame([(k, k, "old", 2020) for k in range(9)], "k int, n int, v string, year int"), table)
    source = spark.createDataFrame([(2, 2**40, True, 2020), (50, 1, False, 2020)], "k int, n bigint, seen boolean, year int")
    with pytest.raises(ValueError, match="int in the target"):
        upsert_table(spark, source, table)
    upsert_table(spark, source, table, evolve=True)
    got = rows_of(read_layer(spark, table.path, PARTS).select("k", "n", "v", "seen", "year"))
    kept = [(k, k, "old", None, 2020) for k in range(9) if k != 2]
    assert got == sorted([*kept, (2, 2**40, None, True, 2020), (50, 1, None, False, 2020)], key=repr)
    upsert_table(spark, spark.createDataFrame([(3, 7, 2020)], "k int, n int, year int"), table, evolve=True)
    assert read_layer(spark, table.path, PARTS).where("k = 3").select("n", "v", "seen").collect() == [(7, None, None)]


# Buckets

ROWS = "k int, j string, v string, year int"


def test_bucketed_table_is_merged_without_shuffling_it(spark, table, plan_of):
    table = replace(table, keys=("j", "k"))
    first = [(k, None if k % 5 == 0 else "j", "a", 2020 + k % 2) for k in range(40)]
    upsert_by_location(spark, spark.createDataFrame(first, ROWS), table, ("j",), buckets=3)
    source = [(k, None if k % 5 == 0 else "j", "b", 2020 + k % 2) for k in range(30, 50)]
    upsert_by_location(spark, spark.createDataFrame(source, ROWS), table, ("j",), buckets=3)
    want = sorted(first[:30] + source, key=repr)
    assert rows_of(spark.table(table.qualified_name).select("k", "j", "v", "year")) == want
    described = spark.sql(f"DESCRIBE EXTENDED {table.qualified_name}").collect()
    assert {r[0]: r[1] for r in described}["Num Buckets"] == "3"
    assert not spark.sql(f"SHOW TABLES IN `{table.database}`").where("tableName <> 't'").collect()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with versions._buckets_by_some_keys(spark):
            target = spark.table(table.qualified_name).where("year = 2020")
            plan = plan_of(merge_frames(target, spark.createDataFrame(source, ROWS), table.keys, ("j",)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    depth = lambda line: len(re.match(r"[ :|+-]*", line)[0])
    above: list[tuple[int, str]] = []
    scans = 0
    for line in plan.splitlines():
        above = [x for x in above if x[0] < depth(line)]
        if f"{table.database}.t[" in line:
            scans += 1
            assert not any("Exchange" in text for _, text in above)
        above.append((depth(line), line))
    assert scans == 2 and plan.count("Exchange hashpartitioning") == 2


def test_buckets_are_merged_some_partitions_at_a_time(spark, table, monkeypatch):
    monkeypatch.setattr(versions, "ROWS_PER_TASK", 8)
    merges = []
    whole = versions.merge_frames
    monkeypatch.setattr(versions, "merge_frames", lambda t, s, *rest: merges.append((t.count(), s.count())) or whole(t, s, *rest))
    table = replace(table, keys=("j", "k"))
    first = [(k, None if k % 5 == 0 else "j", "a", 2020 + k % 4) for k in range(80)]
    upsert_by_location(spark, spark.createDataFrame(first, ROWS), table, ("j",), buckets=3)
    source = [(k, None if k % 5 == 0 else "j", "b", 2020 + k % 6) for k in range(80, 100)]
    source += [(k, j, "b", y) for k, j, _, y in first[60:]]
    upsert_by_location(spark, spark.createDataFrame(source, ROWS), table, ("j",), buckets=3)
    want = sorted(first[:60] + source, key=repr)
    assert rows_of(spark.table(table.qualified_name).select("k", "j", "v", "year")) == want
    assert len(merges) == 5 and sum(t for t, _ in merges) == 80 and sum(s for _, s in merges) == 40
    assert not spark.sql(f"SHOW TABLES IN `{table.database}`").where("tableName <> 't'").collect()


def test_a_query_merges_few_groups_of_partitions(spark, table, monkeypatch, plan_of):
    """What the driver holds does not grow with the table: neither the plan nor keys to be broadcast."""
    monkeypatch.setattr(versions, "ROWS_PER_TASK", 1)
    monkeypatch.setattr(versions, "GROUPS_PER_QUERY", 2)
    scans, physical = [], []
    frames = type(spark.range(0))
    save = frames.write.fget
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()

    def watched(df):
        scans.append(plan(df).count("Relation"))
        physical.append(plan_of(df))
        return save(df)

    monkeypatch.setattr(frames, "write", property(watched))
    first = [(k, "j", "a", 2020 + k % 9) for k in range(90)]
    upsert_by_location(spark, spark.createDataFrame(first, ROWS), table, ("j",), buckets=3)
    source = [(k, "j", "b", 2020 + k % 9) for k in range(45, 99)]
    upsert_by_location(spark, spark.createDataFrame(source, ROWS), table, ("j",), buckets=3)
    assert rows_of(spark.table(table.qualified_name).select("k", "j", "v", "year")) == sorted(first[:45] + source, key=repr)
    assert max(scans) == 8 and len(scans) == 9
    assert not any("Broadcast" in text for text in physical)


def test_buckets_need_a_key_that_is_never_null(spark, table):
    with pytest.raises(ValueError, match="never NULL"):
        upsert_by_location(spark, spark.createDataFrame([], ROWS), table, ("k",), buckets=2)


# What was delivered

HEADER = "vendorid,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,payment_type,total_amount"


def drop(folder, name, trips):
    folder.mkdir(exist_ok=True)
    lines = [f"{v},2020-01-{d:02} 00:00:00,2020-01-{d:02} 00:10:00,1,2.5,{p},{a}" for v, d, p, a in trips]
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")


@pytest.fixture
def config(spark, tmp_path):
    tag = tmp_path.name
    bronze, silver, gold = standard_layers(str(tmp_path), tuple(f"{x}_{tag}" for x in ("b", "s", "g")))
    yield PipelineConfig(str(tmp_path / "drop"), bronze, silver, gold)
    for x in ("b", "s", "g"):
        spark.sql(f"DROP DATABASE IF EXISTS `{x}_{tag}` CASCADE")


def deliver(spark, config, tmp_path, name, trips, delay="3 days"):
    drop(tmp_path / "drop", name, trips)
    ingest_new_files(spark, config, str(tmp_path / "ingested"))
    late = Layer(str(tmp_path / "late"))
    return upsert_distinct_rows(spark, config, str(tmp_path / "merged"), delay, late)


def silver(spark, config):
    return rows_of(read_layer(spark, config.silver.path, ("year", "month")).select("vendorid", "total_amount"))


def late_rows(spark, tmp_path):
    return rows_of(spark.read.parquet(str(tmp_path / "late")).select("vendorid", "total_amount", "batch"))


def test_repeated_deliveries_change_nothing(spark, config, tmp_path):
    first = [(1, 10, "a", 1), (2, 11, "a", 2), ("", 11, "a", 3), ("", 11, "a", 3)]
    assert deliver(spark, config, tmp_path, "1.csv", first) == [StepCount("silver", 3), StepCount("late", 0)]
    again = [(1, 10, "z", 100), ("", 11, "z", 300), (4, 12, "a", 4)]
    assert deliver(spark, config, tmp_path, "2.csv", again) == [StepCount("silver", 1), StepCount("late", 0)]
    assert deliver(spark, config, tmp_path, "3.csv", [(2, 11, "z", 200)]) == [StepCount("silver", 0), StepCount("late", 0)]
    assert silver(spark, config) == [(1, 1.0), (2, 2.0), (4, 4.0), (None, 3.0)]
    assert not list((tmp_path / "silver").glob("*.batch-*"))


def test_late_rows_are_kept_apart_unless_silver_has_them(spark, config, tmp_path):
    deliver(spark, config, tmp_path, "1.csv", [(1, 2, "a", 1), (2, 20, "a", 2)])
    # the watermark is now the 17th
    assert deliver(spark, config, tmp_path, "2.csv", [(1, 2, "z", 9), (3, 3, "a", 3), (4, 18, "a", 4)]) == [
        StepCount("silver", 1),
        StepCount("late", 1),
    ]
    assert silver(spark, config) == [(1, 1.0), (2, 2.0), (4, 4.0)]
    assert [r[:2] for r in late_rows(spark, tmp_path)] == [(3, 3.0)]


def test_batch_that_dies_gives_the_same_rows_again(spark, config, tmp_path, monkeypatch):
    deliver(spark, config, tmp_path, "1.csv", [(1, 2, "a", 1), (2, 20, "a", 2)])
    with monkeypatch.context() as patch:
        real = distinct._write_late
        patch.setattr(distinct, "_write_late", lambda *a: (real(*a), 1 / 0))
        with pytest.raises(Exception, match="division by zero"):
            deliver(spark, config, tmp_path, "2.csv", [(3, 3, "a", 3), (4, 18, "a", 4)])
    assert not list((tmp_path / "silver").glob("*.batch-*"))
    deliver(spark, config, tmp_path, "3.csv", [(5, 19, "a", 5)])
    assert silver(spark, config) == [(1, 1.0), (2, 2.0), (4, 4.0), (5, 5.0)]
    assert [r[:2] for r in late_rows(spark, tmp_path)] == [(3, 3.0)]
    assert Path(tmp_path / "merged").exists()


def test_nothing_to_deliver(spark, config, tmp_path):
    none = [StepCount("silver", 0), StepCount("late", 0)]
    assert upsert_distinct_rows(spark, config, str(tmp_path / "m"), "1 day", Layer(str(tmp_path / "late"))) == none
