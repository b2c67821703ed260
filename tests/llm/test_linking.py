"""Buckets that are shuffled once, and what intermediate tables leave behind."""

import os
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratalake.llm import scratch
from stratalake.llm.linking import link, meeting
from stratalake.llm.words import handing_back

MEMBERS = [(1, 5), (1, 3), (2, 7), (3, 4), (3, 4), (4, 9), (4, 8), (4, 2), (None, 1), (None, 2), (5, None), (5, 6)]


def members(spark):
    return spark.createDataFrame(MEMBERS, "bucket long, node long")


@pytest.mark.parametrize("once", [False, True])
def test_meeting_keeps_shared_buckets(spark, once):
    got = sorted(tuple(r) for r in meeting(members(spark), once=once).collect())
    assert got == [(1, 3, 3, False), (1, 5, 3, False), (4, 2, 2, True), (4, 8, 2, True), (4, 9, 2, True)]


def test_members_are_worked_out_once(spark):
    worked = spark.sparkContext.accumulator(0)

    def seen(row):
        worked.add(1)
        return row

    rows = spark.createDataFrame(spark.sparkContext.parallelize(MEMBERS).map(seen), "bucket long, node long")
    assert meeting(rows, once=True).count() == 5
    assert worked.value == len(MEMBERS)


def test_linked_members_are_removed(spark):
    live = meeting(members(spark))
    folders = {f.rpartition("/")[0].removeprefix("file:") for f in live.inputFiles()}
    traits = spark.range(10).select(F.col("id").alias("node"), F.lit(0).alias("trait"))
    # 8 and 9 are linked, but not with the centre of their bucket
    judged = link(live, lambda pairs: pairs.where("(a = 3 and b = 5) or (a = 8 and b = 9)"), traits, lambda x, y: x == y)
    assert sorted(tuple(r) for r in judged.collect()) == [(3, 3), (5, 3), (8, 8), (9, 8)]
    assert folders and not any(os.path.exists(f"/{f.lstrip('/')}") for f in folders)


def test_store_leaves_no_shuffle_files(spark):
    manager = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffled():
        files = manager.getAllFiles()
        names = {files.apply(i).getName() for i in range(files.size())}
        return {n for n in names if n.startswith("shuffle_")}

    before = shuffled()
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert scratch.store(counts, "counts").count() == 7
    end = time.time() + 10
    while shuffled() - before and time.time() < end:
        time.sleep(0.2)
    left = shuffled() - before
    # the count itself shuffles a row for each of its tasks
    assert not [n for n in left if os.path.getsize(manager.getFile(n).getPath()) > 400], left
    assert spark.conf.get(scratch._CLEANUP) == "false"


def test_freed_memory_is_handed_back(monkeypatch):
    released = []

    class Pool:
        def release_unused(self):
            released.append(True)

    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    batches = [pa.RecordBatch.from_arrays([pa.array([i])], names=["x"]) for i in range(3)]
    assert list(handing_back(lambda found: (b for b in found))(iter(batches))) == batches
    assert released == [True]
