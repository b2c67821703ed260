"""Partitioned Parquet writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.config import Layer
from stratalake.operators.metrics import measure_while
from stratalake.operators.schema import aligned, reconcile
from stratalake.sinks.catalog import note_columns
from stratalake.sources.storage import has_stream_log, table_exists
from stratalake.sources.tables import read_layer

#: Of stored tables. It takes about a quarter less than Spark's default.
CODEC = "zstd"


def write_partitioned(
    rows: DataFrame,
    path: str,
    mode: str,
    partition_columns: Sequence[str],
    only_present: bool = False,
    rebalance: bool = True,
    helper: str | None = None,
    **measures: Column,
) -> dict:
    """Write ``rows`` and return their number as ``rows``, with any further ``measures``.

    Partition columns are integers. Their values become folder names and come back typed.

    ``rebalance`` shuffles rows by partition before the write. Without it every task writes a
    file into every partition it holds a row of. AQE splits a partition that is too large for one
    task into several files, so a month with a third of all rows does not land in one task.
    Switch it off if the rows of a task already belong to one or two partitions.

    ``only_present`` makes an overwrite replace the partitions that ``rows`` holds and leave the
    others. ``helper`` names a column that only the measures need.
    """
    not_whole = [c for c in partition_columns if rows.schema[c].dataType != T.IntegerType()]
    if not_whole:
        raise ValueError(f"partition columns must be of type int, but these are not: {not_whole}")
    laid_out = rows.hint("rebalance", *partition_columns) if rebalance else rows

    def write(frame: DataFrame) -> None:
        if helper is not None:
            frame = frame.drop(helper)
        writer = frame.write.mode(mode).option("compression", CODEC).partitionBy(*partition_columns)
        writer.option("partitionOverwriteMode", "dynamic" if only_present else "static").parquet(path)

    return measure_while(laid_out, write, rows=F.count(F.lit(1)), **measures)


def _require_same_columns(table: DataFrame, rows: DataFrame) -> None:
    """Files of differing types in one folder would make the table unreadable."""
    stored = {f.name: f.dataType.simpleString() for f in table.schema.fields}
    given = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    differing = sorted(name for name in stored.keys() | given.keys() if stored.get(name) != given.get(name))
    if differing:
        raise ValueError(f"rows to append differ from the table in columns {differing}")


def fit_into(spark: SparkSession, rows: DataFrame, layer: Layer) -> DataFrame:
    """``rows`` with the columns of the stored table, which first gets those that it lacks, and wider types where they need them."""
    stored = read_layer(spark, layer.path, layer.partition_columns).schema
    columns = reconcile(stored, rows.schema, layer.partition_columns)
    if columns.changed:
        note_columns(spark, layer, columns)
    return aligned(rows, columns.schema)


def append_or_create(
    spark: SparkSession, rows: DataFrame, layer: Layer, rebalance: bool = True, evolve: bool = False
) -> tuple[str, int]:
    """Create the table on the first load, append to it later. Returns the mode and the row count.

    Rows with other columns or types than the table are refused. With ``evolve`` the table gets new columns, NULL in the rows it
    has, and wider types, and rows are given the columns they lack as NULL; only types that do not go together are refused.
    """
    if has_stream_log(spark, layer.path):
        raise ValueError(f"{layer.path} is filled by a streaming query; rows appended here would stay invisible")
    mode = "append" if table_exists(spark, layer.path) else "overwrite"
    if mode == "append" and evolve:
        rows = fit_into(spark, rows, layer)
    elif mode == "append":
        _require_same_columns(read_layer(spark, layer.path, layer.partition_columns), rows)
    written = write_partitioned(rows, layer.path, mode, layer.partition_columns, rebalance=rebalance)
    return mode, written["rows"]
