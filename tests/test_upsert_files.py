"""Upserts that rewrite only files with a match, publish by renaming, or move catalog partitions to a new folder."""

import random
from collections import Counter
from pathlib import Path

import pytest
from conftest import rows_of
from pyspark.sql import Row
from pyspark.sql import functions as F

from stratalake.config import Layer
from stratalake.operators import DuplicateKeyError, change_rows, matching_files, merge_frames
from stratalake.operators import files as file_search
from stratalake.operators.changes import Changes
from stratalake.sinks import (
    finish_moving,
    finish_pending,
    pending,
    remove_unreferenced,
    upsert,
    upsert_by_location,
    upsert_first_per_key,
    upsert_table,
    versions,
    write_partitioned,
)
from stratalake.sources import data_files, read_layer

PARTS = ("year",)
SCHEMA = "k int, v string, year int"


@pytest.fixture
def layer(tmp_path):
    return Layer(str(tmp_path / "a table"), partition_columns=PARTS, keys=("k",))


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def stored(spark, layer):
    return rows_of(read_layer(spark, layer.path, PARTS).select("k", "v", "year"))


def fill(spark, layer, files=8, rows=100):
    """A table of two years whose files hold consecutive keys."""
    for f in range(files):
        keys = range(f * rows, (f + 1) * rows)
        part = frame(spark, [(k, f"old {k}", 2020 + f % 2) for k in keys]).coalesce(1)
        write_partitioned(part, layer.path, "append", PARTS, rebalance=False)
    return [(k, f"old {k}", 2020 + k // rows % 2) for k in range(files * rows)]


def names(layer):
    return {p.name for p in Path(layer.path).rglob("*.parquet")}


def merged(rows, source):
    new = {r[0]: r for r in source}
    return sorted([new.pop(r[0], r) for r in rows] + list(new.values()), key=repr)


def test_only_files_with_a_match_are_replaced(spark, layer):
    rows = fill(spark, layer)
    before = names(layer)
    source = [(5, "new", 2020), (2, "new", 2020), (999, "added", 2021)]
    result = upsert_table(spark, frame(spark, source), layer)
    assert result.replaced == 1 and result.source_rows == 3
    assert stored(spark, layer) == merged(rows, source)
    assert len(before - names(layer)) == 1 and {p.year for p in result.partitions} == {2020, 2021}


def test_source_without_a_match_replaces_nothing(spark, layer):
    rows = fill(spark, layer)
    before = names(layer)
    assert upsert_table(spark, frame(spark, [(-1, "n", 2020)]), layer).replaced == 0
    assert before < names(layer) and stored(spark, layer) == merged(rows, [(-1, "n", 2020)])


def test_one_shuffle_form_replaces_the_same_files(spark, layer):
    rows = fill(spark, layer)
    before = names(layer)
    source = [(5, "b", 2020), (5, "a", 2020), (150, "c", 2021), (900, "d", 2021)]
    result = upsert_first_per_key(spark, frame(spark, source), layer, ["v"])
    assert result.replaced == 2 and result.source_rows == 3 and len(before - names(layer)) == 2
    assert stored(spark, layer) == merged(rows, [(5, "a", 2020), (150, "c", 2021), (900, "d", 2021)])


def test_large_source_replaces_all_files_of_its_partitions(spark, layer, monkeypatch):
    rows = fill(spark, layer)
    monkeypatch.setattr(upsert, "matching_files", lambda *_: pytest.fail("not worth a look"))
    source = [(k, "new", 2020) for k in range(0, 100)] + [(2000 + k, "new", 2020) for k in range(200)]
    assert upsert_table(spark, frame(spark, source), layer).replaced == 4
    assert stored(spark, layer) == merged(rows, source)


@pytest.mark.parametrize("limit", [0, 1 << 16])
@pytest.mark.parametrize("nullable", [(), ("j",)])
def test_matching_files_are_those_of_a_plain_search(spark, tmp_path, monkeypatch, limit, nullable):
    monkeypatch.setattr(file_search, "FILTER_KEYS", limit)
    rnd = random.Random(limit + len(nullable))
    value = lambda: rnd.choice([None, *range(30)])
    path = str(tmp_path / "with space")
    rows = [(value(), rnd.choice([None, "x", "y"])) for _ in range(300)]
    frame(spark, rows, "k int, j string").repartition(40).write.parquet(path)
    source = [(rnd.choice([None, *range(60)]), rnd.choice([None, "x"])) for _ in range(5)]
    source_rows = frame(spark, source, "k int, j string")
    got = matching_files(spark.read.parquet(path), source_rows, ("k", "j"), 5, nullable)
    keys = {s for s in source if s[0] is not None and (s[1] is not None or nullable)}
    located = spark.read.parquet(path).select("k", "j", "_metadata.file_name").collect()
    assert {f.rpartition("/")[2] for f in got} == {r[2] for r in located if (r[0], r[1]) in keys}


def test_filter_of_bits_has_no_misses_and_few_false_hits(spark):
    source = spark.range(0, 3000).select((F.col("id") * 7).alias("k"), F.lit(None).cast("string").alias("j"))
    condition = file_search.key_filter(source, ("k", "j"), 3000)
    assert source.where(condition).count() == 3000
    others = spark.range(100_000, 200_000).select(F.col("id").alias("k"), F.lit(None).cast("string").alias("j"))
    assert others.where(condition).count() < 4000


def test_key_ranges_reach_the_scan(spark, tmp_path, plan_of):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id k", "timestamp_seconds(id) t").write.parquet(path)
    source = spark.range(3, 5).selectExpr("id k", "timestamp_seconds(id) t")
    found = spark.read.parquet(path).where(file_search.key_ranges(source, ("k", "t"), ()))
    assert found.count() == 2
    plan = plan_of(found)
    assert "GreaterThanOrEqual(k,3)" in plan and "GreaterThanOrEqual(t," in plan


def test_first_load_with_repeated_keys_leaves_no_table(spark, layer):
    with pytest.raises(DuplicateKeyError):
        upsert_table(spark, frame(spark, [(1, "a", 2020), (1, "b", 2020)]), layer)
    assert names(layer) - {p.name for p in Path(layer.path, ".pending").rglob("*")} == set()
    upsert_table(spark, frame(spark, [(1, "c", 2020)]), layer)
    assert stored(spark, layer) == [(1, "c", 2020)]


@pytest.mark.parametrize("dies_at", range(8))
def test_publishing_can_die_anywhere(spark, layer, monkeypatch, dies_at):
    """The mark is set; renames and deletions then stop after ``dies_at`` of them. The next run ends with the right table."""
    rows = fill(spark, layer, files=4)
    source = [(5, "new", 2020), (105, "new", 2021), (999, "added", 2021)]
    left = [dies_at]

    def counted(work):
        def run(*args):
            if left[0] == 0:
                raise RuntimeError("driver lost")
            left[0] -= 1
            return work(*args)

        return run

    with monkeypatch.context() as patch:
        patch.setattr(pending, "each", lambda work, things: [work(x) for x in things])
        patch.setattr(pending, "move", counted(pending.move))
        patch.setattr(pending, "remove", counted(pending.remove))
        real = upsert._publish
        # what a run drops before it begins is not counted
        patch.setattr(upsert, "finish_pending", lambda *_: None)
        patch.setattr(upsert, "_publish", lambda *a: real(*a))
        try:
            upsert_table(spark, frame(spark, source), layer)
        except RuntimeError:
            pass
    finish_pending(spark, layer)
    assert stored(spark, layer) == merged(rows, source)
    assert not Path(layer.path, ".pending").exists()


def test_nothing_is_copied_when_a_table_is_published(spark, layer, monkeypatch):
    fill(spark, layer, files=4)
    written = []
    real = pending.publish
    monkeypatch.setattr(
        upsert, "_publish", lambda s, target: (written.extend(data_files(s, pending.pending_rows(target))), real(s, target))
    )
    before = names(layer)
    upsert_table(spark, frame(spark, [(5, "new", 2020)]), layer)
    assert {Path(f).name for f in written} == names(layer) - before and len(written) >= 1


# Changes


def net(before, changes):
    left = Counter(before)
    for c in changes:
        left[tuple(c[1:])] += 1 if c[0] == "after" else -1
    return +left


def test_change_rows_are_the_difference(spark):
    rnd = random.Random(5)
    key = lambda: rnd.choice([None, *range(9)])
    target = frame(spark, [(key(), f"t{i}", 2020) for i in range(30)])
    source = frame(spark, [(k, f"s{k}", 2020) for k in [None, *range(4, 14)]])
    for nullable in ((), ("k",)):
        changes = change_rows(target, source, ("k",), nullable).select("change", *target.columns).collect()
        after = merge_frames(target, source, ("k",), nullable).collect()
        assert net(map(tuple, target.collect()), changes) == Counter(map(tuple, after))


def test_upserts_deliver_their_changes(spark, layer, tmp_path):
    rows = fill(spark, layer, files=4)
    changes = Changes(str(tmp_path / "changes"), ("k", "v", "year"))
    source = [(5, "new", 2020), (999, "added", 2021)]
    upsert_table(spark, frame(spark, source), layer, changes=changes)
    upsert_table(spark, frame(spark, [(5, "newer", 2020)]), layer, changes=changes)
    folders = sorted(Path(changes.path).iterdir())
    assert len(folders) == 2
    got = [tuple(r) for f in folders for r in spark.read.parquet(str(f)).select("change", "k", "v", "year").collect()]
    assert net(rows, got) == Counter(stored(spark, layer))
    assert sorted(got)[-2:] == [("before", 5, "new", 2020), ("before", 5, "old 5", 2020)]


def test_first_load_delivers_all_rows(spark, layer, tmp_path):
    changes = Changes(str(tmp_path / "changes"), ("k", "year"))
    result = upsert_table(spark, frame(spark, [(1, "a", 2020), (2, "b", None)]), layer, changes=changes)
    assert result.partitions is None and stored(spark, layer) == [(1, "a", 2020), (2, "b", None)]
    assert rows_of(spark.read.parquet(f"{changes.path}/*")) == [("after", 1, 2020), ("after", 2, None)]


def test_run_that_dies_before_publishing_delivers_nothing(spark, layer, tmp_path, monkeypatch):
    rows = fill(spark, layer, files=2)
    changes = Changes(str(tmp_path / "changes"), ("k",))
    with monkeypatch.context() as patch:
        patch.setattr(upsert, "_publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            upsert_table(spark, frame(spark, [(5, "new", 2020)]), layer, changes=changes)
    finish_pending(spark, layer)
    assert stored(spark, layer) == sorted(rows, key=repr) and not Path(changes.path).exists()


# Publishing by location


@pytest.fixture
def table(spark, tmp_path):
    layer = Layer(str(tmp_path / "it's a table"), f"db_{tmp_path.name}", "t", str(tmp_path / "db"), PARTS, ("k",))
    yield layer
    spark.sql(f"DROP DATABASE IF EXISTS `{layer.database}` CASCADE")


def listed(spark, table):
    return rows_of(spark.table(table.qualified_name).select("k", "v", "year"))


def test_partitions_move_to_the_folder_of_each_merge(spark, table):
    first = [(k, "a", 2020 + k % 3) for k in range(9)]
    assert upsert_by_location(spark, frame(spark, first), table).partitions is None
    source = [(0, "b", 2020), (30, "b", 2020), (31, "b", 2024)]
    result = upsert_by_location(spark, frame(spark, source), table)
    assert set(result.partitions) == {Row(year=2020), Row(year=2024)} and result.source_rows == 3
    assert listed(spark, table) == merged(first, source)
    runs = [p for p in Path(table.path).iterdir() if p.name.startswith("run-")]
    # each run holds what it wrote and no more: the rows of the partitions it touched, once
    held = sorted(spark.read.parquet(str(r)).count() for r in runs)
    assert held == [5, 9]


def test_unreferenced_runs_are_removed(spark, table):
    for v in "abc":
        upsert_by_location(spark, frame(spark, [(1, v, 2020), (2, v, 2021)] if v == "a" else [(1, v, 2020)]), table)
    assert len(remove_unreferenced(spark, table)) == 1
    assert remove_unreferenced(spark, table) == []
    assert listed(spark, table) == [(1, "c", 2020), (2, "a", 2021)]


def test_run_that_dies_before_the_move_changes_nothing(spark, table, monkeypatch):
    upsert_by_location(spark, frame(spark, [(1, "a", 2020)]), table)
    with monkeypatch.context() as patch:
        patch.setattr(versions, "write_lines", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            upsert_by_location(spark, frame(spark, [(1, "b", 2020)]), table)
    finish_moving(spark, table)
    assert listed(spark, table) == [(1, "a", 2020)]


def test_run_that_dies_while_moving_is_finished_by_the_next(spark, table, monkeypatch):
    upsert_by_location(spark, frame(spark, [(1, "a", 2020), (2, "a", 2021)]), table)
    real = versions.place_partitions
    with monkeypatch.context() as patch:
        patch.setattr(versions, "place_partitions", lambda s, t, p, f: (real(s, t, p[:1], f), 1 / 0))
        with pytest.raises(ZeroDivisionError):
            upsert_by_location(spark, frame(spark, [(1, "b", 2020), (2, "b", 2021)]), table)
    assert listed(spark, table) == [(1, "b", 2020), (2, "a", 2021)]
    upsert_by_location(spark, frame(spark, [(3, "c", 2020)]), table)
    assert listed(spark, table) == [(1, "b", 2020), (2, "b", 2021), (3, "c", 2020)]


def test_partitions_without_a_value_are_refused(spark, table):
    with pytest.raises(ValueError, match="without a value"):
        upsert_by_location(spark, frame(spark, [(1, "a", None)]), table)
    with pytest.raises(ValueError, match="no merge keys"):
        upsert_by_location(spark, frame(spark, []), Layer(table.path, "d", "t"))


@pytest.mark.parametrize("hot", [False, True])
def test_rows_are_shuffled_once_unless_few_keys_hold_them(spark, layer, monkeypatch, plan_of, hot):
    monkeypatch.setattr(upsert, "SLICE_ROWS", 8)
    plans = []
    write = upsert.write_partitioned
    monkeypatch.setattr(upsert, "write_partitioned", lambda rows, *a, **k: plans.append((plan_of(rows), k)) or write(rows, *a, **k))
    rows = [(1 if hot and k % 2 else k, f"v{k}", 2020 if hot and k % 2 else 2020 + k % 3) for k in range(300)]
    upsert_first_per_key(spark, frame(spark, rows), layer, ["v"])
    later = [(k, f"w{r}", 2020 + k % 3) for k in range(200, 400) for r in (2, 1)] + ([(1, f"w{k}", 2020) for k in range(300)] if hot else [])
    upsert_first_per_key(spark, frame(spark, later), layer, ["v"])
    assert [k.get("rebalance", True) for _, k in plans] == [hot] * 2
    assert hot or [plan.count("Exchange") for plan, _ in plans] == [1, 1]
    first = {}
    for k, v, y in sorted(rows):
        first.setdefault(k, (k, v, y))
    second = {}
    for k, v, y in sorted(later):
        second.setdefault(k, (k, v, y))
    assert stored(spark, layer) == sorted((first | second).values(), key=repr)


@pytest.mark.parametrize("case", ["plain", "null key", "repeated target key"])
def test_large_source_is_merged_in_one_shuffle(spark, layer, monkeypatch, plan_of, case):
    monkeypatch.setattr(upsert, "_broadcast_bytes", lambda _: -1)
    monkeypatch.setattr(upsert, "SLICE_ROWS", 8)
    target = [(k, "a", 2020 + k % 3) for k in range(100)]
    target += {"plain": [], "null key": [(None, "n", 2020)], "repeated target key": [(99, "a2", 2020)]}[case]
    write_partitioned(frame(spark, target), layer.path, "overwrite", PARTS)
    source = [(k, "b", 2020 + k % 3) for k in range(50, 150)] + ([(None, "m", 2020)] if case == "null key" else [])
    plans = []
    write = upsert.write_partitioned
    monkeypatch.setattr(upsert, "write_partitioned", lambda rows, *a, **k: plans.append(plan_of(rows)) or write(rows, *a, **k))
    upsert_table(spark, frame(spark, source), layer)
    want = [r for r in target if r[0] is None or r[0] < 50] + source + ([(99, "b", 2020)] if case == "repeated target key" else [])
    assert stored(spark, layer) == sorted(want, key=repr)
    assert ("Join" in plans[-1]) == (case != "plain")
    assert case != "plain" or plans[-1].count("Exchange") == 1


@pytest.mark.parametrize("shape", ["map<string,int>", "struct<a:map<string,int>>"])
def test_columns_that_cannot_be_ordered_are_merged_by_the_join(spark, shape):
    assert not upsert.can_order(frame(spark, [], f"k int, m {shape}, year int").schema)
    assert upsert.can_order(frame(spark, [], "k int, m array<int>, year int").schema)
