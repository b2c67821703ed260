import random
import shutil
from pathlib import Path

import pytest
from conftest import rows_of
from pyspark.sql import Row
from pyspark.sql import functions as F

from stratalake.config import Layer
from stratalake.operators import DuplicateKeyError, first_per_key, merge_frames
from stratalake.sinks import (
    append_or_create,
    columns_of,
    export_jdbc,
    finish_pending,
    jdbc_options,
    register_table,
    registered_location,
    upsert,
    upsert_first_per_key,
    upsert_table,
    write_partitioned,
)
from stratalake.sources import mark, read_layer

PARTS = ("year",)
SCHEMA = "k int, v string, year int"
TARGET = [(1, "a", 2020), (2, "b", 2020), (3, "c", 2021), (4, "d", None)]
SOURCE = [(2, "B", 2020), (5, "E", 2020), (4, "D", None)]
MERGED = sorted([(1, "a", 2020), (2, "B", 2020), (5, "E", 2020), (3, "c", 2021), (4, "D", None)], key=repr)


@pytest.fixture
def layer(tmp_path):
    return Layer(str(tmp_path / "table"), partition_columns=PARTS, keys=("k",))


def stored(spark, layer):
    return rows_of(read_layer(spark, layer.path, layer.partition_columns))


def data_files(folder):
    return {p.name for p in Path(folder).glob("*.parquet")}


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def test_overwrite_append_and_counts(spark, layer):
    df = frame(spark, TARGET)
    assert append_or_create(spark, df, layer) == ("overwrite", 4)
    assert append_or_create(spark, df, layer) == ("append", 4)
    assert stored(spark, layer) == sorted(TARGET * 2, key=repr)
    assert write_partitioned(df, layer.path, "overwrite", PARTS) == {"rows": 4}
    assert stored(spark, layer) == sorted(TARGET, key=repr)


def test_overwrite_replaces_all_partitions_whatever_the_session_says(spark, layer):
    write_partitioned(frame(spark, TARGET), layer.path, "overwrite", PARTS)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_partitioned(frame(spark, SOURCE), layer.path, "overwrite", PARTS)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert stored(spark, layer) == sorted(SOURCE, key=repr)


def test_stored_tables_are_packed_tightly(spark, layer):
    write_partitioned(frame(spark, TARGET), layer.path, "overwrite", PARTS)
    files = [p.name for p in Path(layer.path).rglob("*.parquet")]
    assert files and all(".zstd." in name for name in files)


def test_append_of_other_types_is_refused(spark, layer):
    append_or_create(spark, frame(spark, TARGET), layer)
    with pytest.raises(ValueError, match=r"\['k'\]"):
        append_or_create(spark, frame(spark, [("x", "a", 2020)], "k string, v string, year int"), layer)


def test_append_to_a_streamed_table_is_refused(spark, layer):
    append_or_create(spark, frame(spark, TARGET), layer)
    mark(spark, f"{layer.path}/_spark_metadata/0")
    with pytest.raises(ValueError, match="streaming"):
        append_or_create(spark, frame(spark, TARGET), layer)


def test_partition_columns_must_be_integers(spark, layer):
    with pytest.raises(ValueError, match="type int"):
        write_partitioned(frame(spark, [(1, "a", "x")], "k int, v string, year string"), layer.path, "overwrite", PARTS)


def test_columns_the_table_lacks_do_not_pick_the_survivor(spark, layer):
    wide = "k int, v string, year int, a int"
    rows = frame(spark, [(1, "x", 2020, 2), (1, "y", 2020, 1)], wide)
    write_partitioned(frame(spark, [(2, "b", 2020)]), layer.path, "overwrite", PARTS)
    upsert_first_per_key(spark, rows, layer)
    assert stored(spark, layer) == [(1, "x", 2020), (2, "b", 2020)]


def test_large_partition_is_split_into_files(spark, tmp_path):
    df = spark.range(0, 400000, 1, 8).select(
        F.col("id").alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
        (F.col("id") % 3).cast("int").alias("year"),
    )
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        write_partitioned(df, str(tmp_path / "t"), "overwrite", PARTS)
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert len(data_files(tmp_path / "t" / "year=0")) > 2


def test_upsert_touches_only_partitions_of_the_source(spark, layer):
    first = upsert_table(spark, frame(spark, TARGET), layer)
    assert (first.source_rows, first.partitions) == (4, None)
    untouched = data_files(f"{layer.path}/year=2021")
    second = upsert_table(spark, frame(spark, SOURCE), layer)
    assert second.source_rows == 3 and {p.year for p in second.partitions} == {2020, None}
    assert stored(spark, layer) == MERGED
    assert data_files(f"{layer.path}/year=2021") == untouched
    upsert_table(spark, frame(spark, SOURCE), layer)
    assert stored(spark, layer) == MERGED


def test_upsert_of_nothing_changes_nothing(spark, layer):
    upsert_table(spark, frame(spark, TARGET), layer)
    assert upsert_table(spark, frame(spark, []), layer).partitions == []
    assert stored(spark, layer) == sorted(TARGET, key=repr)


def test_upsert_leaves_no_scratch_behind(spark, layer):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = {p.name for p in shared.iterdir()}
    for _ in range(2):
        upsert_table(spark, frame(spark, TARGET), layer)
    assert {p.name for p in shared.iterdir()} == before
    assert not Path(layer.path, ".pending").exists()


def test_conflicting_source_is_refused_before_any_change(spark, layer):
    conflict = frame(spark, [(2, "x", 2020), (2, "y", 2020)])
    with pytest.raises(DuplicateKeyError):
        upsert_table(spark, conflict, layer)
    upsert_table(spark, frame(spark, TARGET), layer)
    with pytest.raises(DuplicateKeyError):
        upsert_table(spark, conflict, layer)
    assert stored(spark, layer) == sorted(TARGET, key=repr)


def test_complete_pending_result_is_published_by_the_next_run(spark, layer):
    upsert_table(spark, frame(spark, TARGET), layer)
    write_partitioned(frame(spark, [(1, "new", 2020)]), f"{layer.path}/.pending/rows", "overwrite", PARTS)
    mark(spark, f"{layer.path}/.pending/complete")
    finish_pending(spark, layer)
    assert stored(spark, layer) == sorted([(1, "new", 2020), (3, "c", 2021), (4, "d", None)], key=repr)
    assert not Path(layer.path, ".pending").exists()


def test_incomplete_pending_result_is_dropped(spark, layer):
    upsert_table(spark, frame(spark, TARGET), layer)
    write_partitioned(frame(spark, [(1, "half", 2020)]), f"{layer.path}/.pending/rows", "overwrite", PARTS)
    upsert_table(spark, frame(spark, SOURCE), layer)
    assert stored(spark, layer) == MERGED


def test_run_that_dies_while_publishing_loses_nothing(spark, layer, monkeypatch):
    upsert_table(spark, frame(spark, TARGET), layer)
    real = upsert.finish_pending

    def dies(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(upsert, "_publish", lambda s, target: (mark(s, f"{target.path}/.pending/complete"), dies()))
    with pytest.raises(RuntimeError):
        upsert_table(spark, frame(spark, SOURCE), layer)
    assert stored(spark, layer) == sorted(TARGET, key=repr)
    shutil.rmtree(f"{layer.path}/year=2020")  # as if it died between dropping and replacing a folder
    real(spark, layer)
    assert stored(spark, layer) == MERGED


def test_upsert_needs_keys(spark, tmp_path):
    with pytest.raises(ValueError, match="no merge keys"):
        upsert_table(spark, frame(spark, TARGET), Layer(str(tmp_path / "t")))


WIDE = "k int, j string, a int, b int, year int"


def random_rows(seed, n, nulls=True):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        k = rnd.choice(([None] if nulls else []) + list(range(8)))
        year = None if k is None else 2020 + k % 3
        rows.append((k, rnd.choice("xyz"), rnd.choice([None, 1, 2]), rnd.randrange(100), year))
    return rows


@pytest.mark.parametrize("descending", [False, True])
def test_one_shuffle_form_equals_dedup_then_merge(spark, tmp_path, monkeypatch, descending):
    joined = []
    monkeypatch.setattr(upsert, "upsert_table", lambda *a, **k: joined.append(1) or upsert_table(*a, **k))
    layer = Layer(str(tmp_path / "t"), partition_columns=PARTS, keys=("k", "j"))
    target, rows = frame(spark, random_rows(1, 30), WIDE), frame(spark, random_rows(2, 60), WIDE)
    upsert_first_per_key(spark, target, layer, ["a"], descending, ("k",))
    before = read_layer(spark, layer.path, PARTS)
    unique = first_per_key(rows, ["k", "j"], ["a"], descending)
    want = rows_of(merge_frames(before, unique, ["k", "j"], ["k"]).select("k", "j", "a", "b", "year"))
    joined.clear()
    result = upsert_first_per_key(spark, rows, layer, ["a"], descending, ("k",))
    assert joined == [] and result.source_rows == unique.count()
    assert rows_of(read_layer(spark, layer.path, PARTS).select("k", "j", "a", "b", "year")) == want
    assert {p.year for p in result.partitions} == {r.year for r in rows.collect()}


def test_duplicate_target_keys_fall_back_to_the_join(spark, layer):
    target = [(1, "a", 2020), (1, "a2", 2020), (2, "b", 2020), (2, "b2", 2020)]
    write_partitioned(frame(spark, target), layer.path, "overwrite", PARTS)
    upsert_first_per_key(spark, frame(spark, [(2, "Z", 2020), (2, "Y", 2020), (3, "c", 2020)]), layer)
    want = [(1, "a", 2020), (1, "a2", 2020), (2, "Y", 2020), (2, "Y", 2020), (3, "c", 2020)]
    assert stored(spark, layer) == sorted(want, key=repr)


def test_null_in_a_strict_key_falls_back_to_the_join(spark, layer):
    write_partitioned(frame(spark, [(None, "n", 2020)]), layer.path, "overwrite", PARTS)
    upsert_first_per_key(spark, frame(spark, [(None, "m", 2020)]), layer)
    assert stored(spark, layer) == sorted([(None, "n", 2020), (None, "m", 2020)], key=repr)


def test_rows_that_change_between_readings_fall_back_to_the_join(spark, layer, monkeypatch):
    joined = []
    monkeypatch.setattr(upsert, "upsert_table", lambda *a, **k: joined.append(1) or upsert_table(*a, **k))
    write_partitioned(frame(spark, TARGET), layer.path, "overwrite", PARTS)
    moving = frame(spark, [(7, "m")], "k int, v string").selectExpr(
        "k", "v", "cast(unix_micros(current_timestamp()) % 1000000000 AS int) AS year"
    )
    upsert_first_per_key(spark, moving, layer)
    assert joined == [1]
    assert [r[:2] for r in stored(spark, layer) if r[0] == 7] == [(7, "m")]
    assert len(stored(spark, layer)) == len(TARGET) + 1


def test_one_shuffle_form_shuffles_once(spark, plan_of):
    target, rows = frame(spark, TARGET), frame(spark, SOURCE)
    plan = plan_of(upsert.first_per_key_over(target, rows, ["k"]))
    assert plan.count("Exchange") == 1 and "partial_min" in plan and "Join" not in plan


def test_register_is_repeatable_and_finds_new_partitions(spark, tmp_path):
    layer = Layer(str(tmp_path / "it's here"), "stratalake_test_db", "t", str(tmp_path / "db"), PARTS, ("k",))
    assert registered_location(spark, layer) is None
    df = frame(spark, TARGET)
    write_partitioned(df, layer.path, "overwrite", PARTS)
    assert register_table(spark, layer, df.schema) is True
    assert rows_of(spark.table(layer.qualified_name)) == sorted(TARGET, key=repr)
    write_partitioned(frame(spark, [(9, "z", 2030)]), layer.path, "append", PARTS)
    assert register_table(spark, layer, df.schema) is False
    assert spark.table(layer.qualified_name).filter("year = 2030").count() == 1
    write_partitioned(frame(spark, [(9, "y", 2031)]), layer.path, "append", PARTS)
    assert register_table(spark, layer, df.schema, [Row(year=2031), Row(year=2020)]) is False
    assert spark.table(layer.qualified_name).filter("year = 2031").count() == 1
    write_partitioned(frame(spark, [(9, "n", None)]), layer.path, "append", PARTS)
    assert register_table(spark, layer, df.schema, [Row(year=None)]) is False
    assert spark.table(layer.qualified_name).filter("year is null").count() == 2
    elsewhere = Layer(str(tmp_path / "other"), "stratalake_test_db", "t", partition_columns=PARTS)
    with pytest.raises(ValueError, match="is registered at"):
        register_table(spark, elsewhere, df.schema)
    spark.sql("DROP DATABASE stratalake_test_db CASCADE")


def test_register_needs_names(spark, layer):
    with pytest.raises(ValueError, match="no database and table name"):
        register_table(spark, layer, frame(spark, TARGET).schema)


def test_columns_of_lists_partitions_last_with_their_types(spark):
    df = spark.createDataFrame([], "year int, k bigint, s struct<a:int>, region string")
    assert columns_of(df.schema, ("year", "region")) == [
        ("k", "bigint", False),
        ("s", "struct<a:int>", False),
        ("year", "int", True),
        ("region", "string", True),
    ]


def test_jdbc_options():
    got = jdbc_options("jdbc:postgresql://host/db", "gold", user="u", connections=2)
    assert got["numPartitions"] == "2" and got["truncate"] == "true" and got["user"] == "u"
    assert "password" not in got and "driver" not in got
    for bad in ({"url": "postgresql://host"}, {"url": "jdbc:x:y", "connections": 0}):
        with pytest.raises(ValueError):
            jdbc_options(**{"table": "t", **bad})


def test_jdbc_export_without_driver_fails_and_says_so(spark):
    with pytest.raises(Exception, match="(?i)driver"):
        export_jdbc(spark.range(1), "jdbc:nosuchdatabase:x", "t")
