"""The upsert of a table that is read through the catalog: each merge writes a fresh folder, and its partitions move there.

Every byte is written once. A reader of the catalog table sees each partition whole, as it was or as it is, since the catalog
moves it in one step. The folders of the table's path are runs, not partitions, so the table is read by name only.

A note beside the runs names the folder whose partitions are to move. It is written when the folder is complete and removed when all have
moved, so the next run finishes a move that was cut short, and a run that dies before the note changes nothing. One
writer per table at a time. Folders that no partition is left in go with :func:`remove_unreferenced`, not before
readers that listed their files are done.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession

from stratalake.config import Layer
from stratalake.operators.dedup import require_unique
from stratalake.operators.merge import merge_frames
from stratalake.sinks.catalog import create_table, place_partitions, registered_location
from stratalake.sinks.partitioned import write_partitioned
from stratalake.sinks.upsert import UpsertResult, _broadcast_bytes, _without_counts, merge_in_one_shuffle
from stratalake.sources.storage import child_folders, data_files, file_of, read_lines, remove, size_in_bytes, write_lines
from stratalake.sources.tables import in_partitions, partition_counts

#: Rows of one bucket, of table and source together, that a task joins and sorts, unless a single partition holds more.
ROWS_PER_TASK = 1 << 20
#: Groups of partitions that one query merges. The driver holds the plan of a query, which grows with these.
GROUPS_PER_QUERY = 4


def _note(layer: Layer) -> str:
    return f"{layer.path}/_moving/folders"


def _partitions_below(spark: SparkSession, layer: Layer, folder: str) -> list[Row]:
    """The partitions that a run wrote, from its folder names."""
    places = sorted({f.rpartition("/")[0] for f in data_files(spark, folder)})
    named = [dict(part.split("=", 1) for part in p.split("/")[-len(layer.partition_columns) :]) for p in places]
    return [Row(**{c: int(p[c]) for c in layer.partition_columns}) for p in named]


def finish_moving(spark: SparkSession, layer: Layer) -> None:
    """Move what an earlier run noted to move and did not come to. Repeating a move changes nothing."""
    for folder in read_lines(spark, _note(layer)):
        place_partitions(spark, layer, _partitions_below(spark, layer, folder), folder)
    remove(spark, _note(layer))


def bucket_columns(layer: Layer, nullable_keys: Sequence[str]) -> list[str]:
    """The keys that can tell the bucket of a row. A key that matches as NULL compares by more than its value, so it cannot."""
    return [k for k in layer.keys if k not in nullable_keys]


@contextmanager
def _bucketed(
    spark: SparkSession, frames: Iterable[DataFrame], layer: Layer, folder: str, buckets: Sequence[str], count: int
) -> Iterator[DataFrame]:
    """Write the rows of ``frames``, one after the other, in buckets and read them as such; their files stay."""
    # Spark names and uses the files of buckets only for a table
    name = f"`{layer.database}`.`{layer.table}_{uuid.uuid4().hex}`"
    try:
        for rows in frames:
            writer = rows.write.format("parquet").option("path", folder).partitionBy(*layer.partition_columns)
            writer.bucketBy(count, *buckets).sortBy(*buckets).mode("append").saveAsTable(name)
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _groups(counts: dict[Row, int], most: int) -> list[list[Row]]:
    """The partitions in order, as many together as hold ``most`` rows; a larger one stays alone."""
    groups: list[list[Row]] = []
    held = 0
    for partition in sorted(counts):
        if not groups or held + counts[partition] > most:
            groups.append([])
            held = 0
        groups[-1].append(partition)
        held += counts[partition]
    return groups


def _merged_by_bucket(
    target: DataFrame, source: DataFrame, layer: Layer, nullable_keys: Sequence[str], count: int
) -> Iterator[DataFrame]:
    """The merge of two frames that lie in the same buckets, some partitions at a time, so that no task holds a bucket of all.

    A key lies in one partition, so the merges of groups of partitions add up to that of the whole. A few of them make a frame.
    """
    parts = layer.partition_columns
    counts: Counter[Row] = Counter()
    for frame in (target, source):
        for p in partition_counts(frame, parts):
            counts[_without_counts([p], parts)[0]] += p["row_count"]
    merges = [
        merge_frames(target.filter(group), source.filter(group), layer.keys, nullable_keys)
        for group in (in_partitions(g, parts) for g in _groups(counts, count * ROWS_PER_TASK))
    ]
    for start in range(0, len(merges), GROUPS_PER_QUERY):
        yield reduce(DataFrame.unionByName, merges[start : start + GROUPS_PER_QUERY])


@contextmanager
def _buckets_by_some_keys(spark: SparkSession) -> Iterator[None]:
    """Spark otherwise shuffles a side that is laid out by some of the keys of a join instead of all, or collects the keys of millions of
    rows in the driver to broadcast them, for it takes them to be as small as their share of the files."""
    settings = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def upsert_by_location(
    spark: SparkSession,
    source: DataFrame,
    layer: Layer,
    nullable_keys: Sequence[str] = (),
    check_source: bool = True,
    buckets: int = 0,
) -> UpsertResult:
    """Merge ``source`` into the catalog table of ``layer`` on the layer's keys, or create the table.

    The layer's keys must determine its partition columns, whose values cannot be NULL. ``check_source`` as for ``upsert_table``.

    With ``buckets`` the table is created with so many buckets of the keys in each partition. Each merge then joins bucket with bucket,
    some partitions at a time: the source is laid out in the table's buckets, and the table, however large, is not shuffled. Later merges
    need the same number. At least one key must not be in ``nullable_keys``.
    """
    if not layer.keys:
        raise ValueError(f"{layer.path} has no merge keys")
    parts, by = layer.partition_columns, bucket_columns(layer, nullable_keys)
    if buckets and not by:
        raise ValueError("a bucket needs a key that is never NULL")
    known = registered_location(spark, layer) is not None
    if known:
        finish_moving(spark, layer)
    staged_path = f"{layer.path}.merge-source-{uuid.uuid4().hex}"
    try:
        source.write.parquet(staged_path)
        staged = spark.read.schema(source.schema).parquet(staged_path)
        if check_source:
            require_unique(staged, layer.keys, nullable_keys)
        touched = partition_counts(staged, parts)
        if any(None in tuple(p) for p in touched):
            raise ValueError(f"rows without a value in one of {list(parts)}")
        create_table(spark, layer, source.schema, (buckets, by) if buckets else None)
        if not touched:
            return UpsertResult(0, [] if known else None)
        folder = f"{layer.path}/run-{uuid.uuid4().hex}"
        target = spark.table(layer.qualified_name).filter(in_partitions(touched, parts)) if known else None
        if buckets:
            laid_out = staged.hint("rebalance", *parts)
            place = f"{staged_path}-buckets" if known else folder
            with _buckets_by_some_keys(spark), _bucketed(spark, [laid_out], layer, place, by, buckets) as source:
                if known:
                    merged = _merged_by_bucket(target, source, layer, nullable_keys, buckets)
                    with _bucketed(spark, merged, layer, folder, by, buckets):
                        pass
        else:
            small = size_in_bytes(spark, staged_path) <= _broadcast_bytes(spark)
            if not known or small or not merge_in_one_shuffle(target, staged, layer, nullable_keys, folder):
                merged = merge_frames(target, staged, layer.keys, nullable_keys) if known else staged
                write_partitioned(merged, folder, "overwrite", parts)
        write_lines(spark, _note(layer), [folder])
        finish_moving(spark, layer)
        rows = sum(p["row_count"] for p in touched)
        return UpsertResult(rows, _without_counts(touched, parts) if known else None)
    finally:
        remove(spark, staged_path)
        remove(spark, f"{staged_path}-buckets")


def remove_unreferenced(spark: SparkSession, layer: Layer) -> list[str]:
    """Delete the runs that no partition of the catalog table is placed in, and return them."""
    finish_moving(spark, layer)
    spark.catalog.refreshTable(layer.qualified_name)
    used = {file_of(f).rpartition("/run-")[2].split("/")[0] for f in spark.table(layer.qualified_name).inputFiles()}
    unused = [f for f in child_folders(spark, layer.path) if f.rpartition("/run-")[2] not in used and "/run-" in f]
    for folder in unused:
        remove(spark, folder)
    return unused
