"""Reading stored layers, whole or by partition."""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.sources.storage import read_lines


def schema_note(path: str) -> str:
    return f"{path}/_schema/columns"


def noted_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The columns of a table that got some, or wider ones, after its first load."""
    lines = read_lines(spark, schema_note(path))
    return T.StructType.fromJson(json.loads(lines[0])) if lines else None


def read_layer(spark: SparkSession, path: str, partition_columns: Sequence[str] = ()) -> DataFrame:
    """Scan a stored table. Partition columns are integers, also if all their values are NULL.

    Files from before a column was added or widened are read with the table's columns of today.
    """
    noted = noted_schema(spark, path)
    if noted is not None:
        return spark.read.schema(noted).parquet(path)
    table = spark.read.parquet(path)
    wrong = [f.name for f in table.schema.fields if f.name in partition_columns and f.dataType != T.IntegerType()]
    if not wrong:
        return table
    fields = [T.StructField(f.name, T.IntegerType()) if f.name in wrong else f for f in table.schema.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def read_files(spark: SparkSession, path: str, files: Sequence[str], schema: T.StructType) -> DataFrame:
    """Some files of the table at ``path``, with the table's columns."""
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*files)


def partition_counts(rows: DataFrame, partition_columns: Sequence[str], **measures: Column) -> list[Row]:
    """The partitions of ``rows`` with their row counts as ``row_count``: one row per table folder."""
    counts = [F.count(F.lit(1)).alias("row_count"), *[column.alias(name) for name, column in measures.items()]]
    return rows.groupBy(*partition_columns).agg(*counts).collect()


def _any_of(conditions: Sequence[Column]) -> Column:
    """OR as a balanced tree; a chain of thousands would exhaust the optimizer's stack."""
    if not conditions:
        return F.lit(False)
    if len(conditions) == 1:
        return conditions[0]
    half = len(conditions) // 2
    return _any_of(conditions[:half]) | _any_of(conditions[half:])


def _one_of(column: str, values: Sequence) -> Column:
    known = [v for v in values if v is not None]
    found = [F.col(column).isin(known)] if known else []
    return _any_of(found + ([F.col(column).isNull()] if len(known) < len(values) else []))


def in_partitions(partitions: Sequence[Row], partition_columns: Sequence[str]) -> Column:
    """A filter for the given partitions on the stored partition columns alone.

    Spark evaluates it on folder names, so files of other partitions are not read.
    """
    *outer, inner = partition_columns
    folders = defaultdict(list)
    for values in partitions:
        folders[tuple(values[c] for c in outer)].append(values[inner])
    return _any_of(
        [
            reduce(lambda a, b: a & b, [_one_of(c, [v]) for c, v in zip(outer, prefix)] + [_one_of(inner, found)])
            for prefix, found in folders.items()
        ]
    )
