"""The stored form of the upsert: rewrite the files that hold a match, in the partitions that the source touches.

The layer's keys must determine its partition columns, so that a match can only lie in the same
partition. Of these partitions only files with a matching key are read and replaced; the others keep their names. Looking for
them reads the key columns once more. A source of more than half as many rows as its partitions hold is taken to match
every file instead.

The result is written once and published by renaming, see :mod:`stratalake.sinks.pending`. A run that dies at any point
loses nothing. One writer per table at a time.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.config import Layer
from stratalake.operators.changes import Changes, change_rows
from stratalake.operators.dedup import as_sortable, first_per_key, require_unique
from stratalake.operators.files import matching_files
from stratalake.operators.merge import check_columns, merge_frames
from stratalake.sinks import pending
from stratalake.sinks.partitioned import fit_into, write_partitioned
from stratalake.sinks.pending import finish_pending
from stratalake.sinks.pending import pending_mark as _pending_mark
from stratalake.sinks.pending import pending_rows as _pending_rows
from stratalake.sources.storage import remove, size_in_bytes, table_exists
from stratalake.sources.tables import in_partitions, partition_counts, read_files, read_layer

#: Matching files are looked for if the touched partitions hold at least so many rows per source row.
PROBE_FACTOR = 2


@dataclass(frozen=True)
class UpsertResult:
    """``partitions`` lists the partitions that were changed, or is None after a first load; ``replaced`` files went."""

    source_rows: int
    partitions: list[Row] | None
    replaced: int = 0


def _without_counts(partitions: Sequence[Row], partition_columns: Sequence[str]) -> list[Row]:
    return [Row(**{c: p[c] for c in partition_columns}) for p in partitions]


def _broadcast_bytes(spark: SparkSession) -> int:
    """Stored size up to which a source is taken to be broadcast; a table read from Parquet is larger in memory."""
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold() // 4


def _publish(spark: SparkSession, layer: Layer) -> None:
    pending.publish(spark, layer)


def _matched(
    spark: SparkSession, layer: Layer, source: DataFrame, touched: Sequence[Row], nullable_keys: Sequence[str]
) -> tuple[DataFrame, list[str]]:
    """Target rows of the files that are to be rewritten, and these files."""
    parts = layer.partition_columns
    target = read_layer(spark, layer.path, parts).filter(in_partitions(touched, parts))
    source_rows = sum(p["row_count"] for p in touched)
    if target.count() < PROBE_FACTOR * source_rows:  # read from the files' footers
        return target, pending.files_of_partitions(spark, layer, touched)
    files = matching_files(target, source.select(*layer.keys), layer.keys, source_rows, nullable_keys)
    return read_files(spark, layer.path, files, target.schema), files


def _first_load(
    spark: SparkSession, source: DataFrame, layer: Layer, nullable_keys: Sequence[str] | None, rebalance: bool = True
) -> UpsertResult:
    """Write the table once; it appears when its keys are known to be unique. Without ``nullable_keys`` they are not checked."""
    rows = write_partitioned(source, _pending_rows(layer), "overwrite", layer.partition_columns, rebalance=rebalance)["rows"]
    if rows and nullable_keys is not None:
        require_unique(read_layer(spark, _pending_rows(layer), layer.partition_columns), layer.keys, nullable_keys)
    pending.note_obsolete(spark, layer, [])
    _publish(spark, layer)
    return UpsertResult(rows, None)


def can_order(schema: T.StructType) -> bool:
    """Whether rows can be picked by comparing them."""
    return not any(kind in schema.simpleString() for kind in ("map<", "variant"))


def null_in_key(keys: Sequence[str], nullable_keys: Sequence[str]) -> Column:
    """Whether a key is NULL that then matches nothing."""
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys if k not in nullable_keys], F.lit(False))


def merge_in_one_shuffle(target: DataFrame, source: DataFrame, layer: Layer, nullable_keys: Sequence[str], path: str) -> bool:
    """Write ``merge_frames`` of a source with unique keys to ``path``, merged and laid out in one shuffle of both.

    Returns whether it could: keys that are never NULL unless they match as such, and a target that holds each once.
    """
    parts, keys = layer.partition_columns, layer.keys
    if not can_order(target.schema):
        return False
    profile = partition_counts(source, parts, null_keys=F.count_if(null_in_key(keys, nullable_keys)))
    held, hot = _partition_profile(target, parts, keys)
    if hot or any(p["null_keys"] for p in profile):
        return False
    counts = _both_counts(held, profile, parts)
    grouped = [*(c for c in parts if c not in keys), _SLICE, *keys]
    merged = first_per_key_over(target, source, grouped, deal=lambda both: _dealt_by_slice(both, counts, parts, keys))
    unusable = (F.col(_TARGET_ROWS) > 1).cast("byte")
    written = write_partitioned(
        merged.withColumn("__origin", unusable).drop(_FROM_TARGET, _TARGET_ROWS),
        path,
        "overwrite",
        parts,
        rebalance=False,
        helper="__origin",
        unusable=F.count_if(F.col("__origin") == 1),
    )
    return not written["unusable"]


def upsert_table(
    spark: SparkSession,
    source: DataFrame,
    layer: Layer,
    nullable_keys: Sequence[str] = (),
    check_source: bool = True,
    changes: Changes | None = None,
    evolve: bool = False,
) -> UpsertResult:
    """Merge ``source`` into the table of ``layer`` on the layer's keys, or create the table.

    A source to be merged is first written to a folder beside the table. That cuts its lineage, gives the
    optimizer its true size, and keeps it from being computed for each of its uses.
    ``check_source`` costs an aggregation over the keys; switch it off for a source that is
    unique by construction. With ``changes`` the rows before and after go to a folder of their own; they appear there
    in the same step as in the table, and not at all if the run dies before it. The source needs all columns of the table, in
    their types, and others are ignored; ``evolve`` fits the two together as for ``append_or_create``.
    """
    if not layer.keys:
        raise ValueError(f"{layer.path} has no merge keys")
    finish_pending(spark, layer)
    parts = layer.partition_columns
    first_load = not table_exists(spark, layer.path)
    if first_load and changes is None:
        return _first_load(spark, source, layer, nullable_keys if check_source else None)

    staged_path = f"{layer.path.rstrip('/')}.merge-source-{uuid.uuid4().hex}"
    try:
        source.write.parquet(staged_path)
        staged = spark.read.schema(source.schema).parquet(staged_path)
        if check_source:
            require_unique(staged, layer.keys, nullable_keys)
        touched = partition_counts(staged, parts)
        source_rows = sum(p["row_count"] for p in touched)
        if not touched:
            return UpsertResult(0, None if first_load else [])
        if evolve and not first_load:
            staged = fit_into(spark, staged, layer)
        if first_load:
            target, files = staged.limit(0), []
        else:
            check_columns(read_layer(spark, layer.path, parts), staged)
            target, files = _matched(spark, layer, staged, touched, nullable_keys)
        small = size_in_bytes(spark, staged_path) <= _broadcast_bytes(spark)
        # a source that travels to each task needs no shuffle of the keys
        if first_load or small or not merge_in_one_shuffle(target, staged, layer, nullable_keys, _pending_rows(layer)):
            merged = merge_frames(target, staged, layer.keys, nullable_keys, small_source=small)
            write_partitioned(merged, _pending_rows(layer), "overwrite", parts)
        if changes is not None:
            rows = change_rows(target, staged, layer.keys, nullable_keys)
            rows.select("change", *changes.columns).write.mode("overwrite").parquet(pending.pending_changes(layer))
            pending.note_destination(spark, layer, f"{changes.path}/{uuid.uuid4().hex}")
        pending.note_obsolete(spark, layer, files)
        _publish(spark, layer)
        return UpsertResult(source_rows, None if first_load else _without_counts(touched, parts), len(files))
    finally:
        remove(spark, staged_path)


#: A task of the one shuffle gets some slices of partitions, each of about so many rows and written as one file.
SLICE_ROWS = 1 << 18
#: Slices by which the rows of each partition are first counted, and how many times its even share one of them may
#: hold before its rows are taken to be those of few keys, which are to be reduced before they are shuffled.
PROBE_SLICES, HOT_FACTOR = 16, 4

_SLICE = "__slice"


def _slice(keys: Sequence[str], count: int | Column) -> Column:
    return F.pmod(F.xxhash64(*keys, F.lit("slice")), F.lit(count) if isinstance(count, int) else count)


def _partition_profile(rows: DataFrame, parts: Sequence[str], keys: Sequence[str], **measures: Column) -> tuple[list[Row], bool]:
    """``partition_counts`` with the sums of ``measures``, and whether some keys hold a large share of the rows."""
    sliced = partition_counts(rows.withColumn(_SLICE, _slice(keys, PROBE_SLICES)), [*parts, _SLICE], **measures)
    names = ["row_count", *measures]
    sums: dict[tuple, list[int]] = {}
    largest: dict[tuple, int] = {}
    for r in sliced:
        p = tuple(r[c] for c in parts)
        sums[p] = [a + r[n] for a, n in zip(sums.get(p, [0] * len(names)), names, strict=True)]
        largest[p] = max(largest.get(p, 0), r["row_count"])
    profile = [Row(**dict(zip(parts, p, strict=True)), **dict(zip(names, n, strict=True))) for p, n in sums.items()]
    hot = any(n > max(SLICE_ROWS, HOT_FACTOR * sums[p][0] / PROBE_SLICES) for p, n in largest.items())
    return profile, hot


def _both_counts(stored: Sequence[Row], given: Sequence[Row], parts: Sequence[str]) -> list[Row]:
    counts: Counter[Row] = Counter()
    for p in (*stored, *given):
        counts[_without_counts([p], parts)[0]] += p["row_count"]
    return [Row(**p.asDict(), row_count=n) for p, n in counts.items()]


def _dealt_by_slice(rows: DataFrame, profile: Sequence[Row], parts: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """``rows`` shuffled once, so that a key and a file's rows are in one task, with the column ``__slice``.

    ``profile`` has the rows per partition.
    """
    sizes: dict[int, list[Row]] = {}
    for p in profile:
        sizes.setdefault(1 << max(0, -(-p["row_count"] // SLICE_ROWS) - 1).bit_length(), []).append(p)
    count = F.lit(1)
    for slices, some in sizes.items():
        if slices > 1:
            count = F.when(in_partitions(some, parts), slices).otherwise(count)
    groups = sum(slices * len(some) for slices, some in sizes.items())
    total = sum(p["row_count"] for p in profile)
    tasks = min(2 * groups, 1 + 2 * total // SLICE_ROWS)
    # as a column to group by, so that Spark sees that the groups are together
    return rows.withColumn(_SLICE, _slice(keys, count)).repartition(tasks, *parts, _SLICE)


_FROM_TARGET = "__from_target"
_TARGET_ROWS = "__target_rows"


def first_per_key_over(
    target: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    descending: bool = False,
    deal: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Deduplicate ``rows`` and upsert them into ``target`` in one shuffle.

    A row of ``rows`` always goes before a target row of its key. The target must hold each key
    once, and NULLs count as equal keys. ``__from_target`` says where the result's row is from,
    and ``__target_rows`` how many target rows had its key. ``deal`` shuffles the rows of both by
    some of the keys, of which it may add some.
    """
    # The flag leads the order, so its larger value must lose.
    losing = F.lit(not descending)
    winning = F.lit(descending)
    both = target.withColumn("__rank", losing).unionByName(rows.select(*target.columns).withColumn("__rank", winning))
    if deal is not None:
        both = deal(both)
    pick = F.max if descending else F.min
    return (
        both.groupBy(*keys)
        .agg(
            pick(as_sortable(both.columns, keys, ["__rank", *order])).alias("__best"),
            F.count_if(F.col("__rank") == losing).alias(_TARGET_ROWS),
        )
        .select(*keys, "__best.*", _TARGET_ROWS)
        .select(*target.columns, (F.col("__rank") == losing).alias(_FROM_TARGET), _TARGET_ROWS)
    )


def upsert_first_per_key(
    spark: SparkSession,
    rows: DataFrame,
    layer: Layer,
    order: Sequence[str] = (),
    descending: bool = False,
    nullable_keys: Sequence[str] = (),
) -> UpsertResult:
    """Merge the first of ``rows`` per key of ``layer`` into its table, or create the table.

    Same table as ``upsert_table(first_per_key(rows, ...))``. A source of any size is deduplicated,
    merged and laid out in one shuffle of source and target: by partition and slice of the keys, so a task holds
    whole keys and writes few files. If some keys hold a large share of a partition, a shuffle by key, which sends one row per key and
    input partition, and one that lays out the files take its place. The one shuffle needs a target without duplicate keys and
    keys that are never NULL unless they may match as NULL. Both are checked along the way; where they do not hold the join does the
    work instead.

    ``rows`` is read first for its partitions and key columns alone, and then for the merge. Should the
    second reading bring other partitions, the join, which reads once, takes over as well. A source that changes its rows
    between the readings otherwise is not safe here: stage it.
    """
    finish_pending(spark, layer)
    parts, keys = layer.partition_columns, layer.keys

    if table_exists(spark, layer.path):
        # Columns the table lacks must not decide which duplicate survives either.
        stored = read_layer(spark, layer.path, parts)
        check_columns(stored, rows)
        rows = rows.select(*stored.columns)
    else:
        stored = None

    def joined() -> UpsertResult:
        unique = first_per_key(rows, keys, order, descending)
        return upsert_table(spark, unique, layer, nullable_keys, check_source=False)

    profile, hot = _partition_profile(rows, parts, keys, null_keys=F.count_if(null_in_key(keys, nullable_keys)))
    # the keys determine the partition; with it in front the rows of a task come out as the files want them
    grouped = [*(c for c in parts if c not in keys), _SLICE, *keys]
    if stored is None:
        if hot or not profile:
            return joined()
        unique = first_per_key(_dealt_by_slice(rows, profile, parts, keys), grouped, order, descending)
        return _first_load(spark, unique.drop(_SLICE), layer, None, rebalance=False)
    if any(p["null_keys"] for p in profile):
        return joined()
    if not profile:
        return UpsertResult(0, [])

    target, files = _matched(spark, layer, rows, profile, nullable_keys)
    deal = None
    if not hot:
        held = _both_counts(partition_counts(target, parts), profile, parts)
        deal = lambda both: _dealt_by_slice(both, held, parts, keys)
    # Rows of a partition that the first reading did not show would replace that partition unmerged.
    unusable = (F.col(_TARGET_ROWS) > 1) | ~F.coalesce(in_partitions(profile, parts), F.lit(False))
    by = keys if hot else grouped
    merged = first_per_key_over(target, rows, by, order, descending, deal).withColumn(
        "__origin", F.when(unusable, 2).when(F.col(_FROM_TARGET), 1).otherwise(0).cast("byte")
    )
    written = write_partitioned(
        merged.drop(_FROM_TARGET, _TARGET_ROWS),
        _pending_rows(layer),
        "overwrite",
        parts,
        rebalance=hot,
        helper="__origin",
        source_rows=F.count_if(F.col("__origin") == 0),
        unusable=F.count_if(F.col("__origin") == 2),
    )
    if written["unusable"]:
        return joined()
    pending.note_obsolete(spark, layer, files)
    _publish(spark, layer)
    return UpsertResult(written["source_rows"], _without_counts(profile, parts), len(files))
