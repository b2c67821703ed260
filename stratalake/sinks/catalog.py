"""Registering stored layers as external tables in the session catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Row, SparkSession
from pyspark.sql import types as T

from stratalake.config import Layer
from stratalake.operators.schema import Reconciled
from stratalake.sources.storage import partition_folder, qualified, write_lines
from stratalake.sources.tables import schema_note


def columns_of(schema: T.StructType, partition_columns: Sequence[str] = ()) -> list[tuple[str, str, bool]]:
    """Name, type text and "is a partition column" of each column, partition columns last."""
    listed = [(f.name, f.dataType.simpleString(), f.name in partition_columns) for f in schema.fields]
    return sorted(listed, key=lambda column: column[2])


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def registered_location(spark: SparkSession, layer: Layer) -> str | None:
    """Where the layer's catalog table points, or None if it is not registered."""
    if not spark.catalog.databaseExists(layer.database) or not spark.catalog.tableExists(layer.qualified_name):
        return None
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {layer.qualified_name}")
    return details.filter("col_name = 'Location'").first()["data_type"]


def _spec(layer: Layer, values: Row) -> str:
    return "PARTITION (" + ", ".join(f"`{c}` = {values[c]}" for c in layer.partition_columns) + ")"


def _add_partitions(spark: SparkSession, layer: Layer, partitions: Sequence[Row]) -> None:
    for start in range(0, len(partitions), 100):
        specs = " ".join(_spec(layer, p) for p in partitions[start : start + 100])
        spark.sql(f"ALTER TABLE {layer.qualified_name} ADD IF NOT EXISTS {specs}")


def place_partitions(spark: SparkSession, layer: Layer, partitions: Sequence[Row], folder: str) -> None:
    """Let the catalog find these partitions below ``folder``, whether it knew them or not.

    Each of them moves in one step; readers that began before go on with the files they listed.
    """
    for p in partitions:
        if None in tuple(p):
            raise ValueError(f"a partition without a value cannot be placed: {p}")
    name = layer.qualified_name
    known = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    moving, new = [], []
    for p in partitions:
        folders = partition_folder("", p, layer.partition_columns)[1:]
        place = _spec(layer, p), f"LOCATION {_text(f'{folder}/{folders}')}"
        (moving if folders in known else new).append(place)
    for start in range(0, len(new), 100):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(' '.join(p) for p in new[start : start + 100])}")
    for spec, location in moving:
        spark.sql(f"ALTER TABLE {name} {spec} SET {location}")
    spark.catalog.refreshTable(layer.qualified_name)


def create_table(
    spark: SparkSession, layer: Layer, schema: T.StructType, buckets: tuple[int, Sequence[str]] | None = None
) -> bool:
    """Create the layer's catalog table over its path, without partitions, if it is missing. Returns whether it was.

    ``buckets`` are the number of buckets of each partition and the columns that tell and order them.

    A table of that name that points elsewhere is an error rather than silently kept.
    """
    if layer.qualified_name is None:
        raise ValueError(f"{layer.path} has no database and table name")
    known = registered_location(spark, layer)
    if known is not None and qualified(spark, known) != qualified(spark, layer.path):
        raise ValueError(f"{layer.qualified_name} is registered at {known}, not at {layer.path}")
    if known is None:
        place = f" LOCATION {_text(layer.database_location)}" if layer.database_location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer.database}`{place}")
        columns = ", ".join(f"`{name}` {kind}" for name, kind, _ in columns_of(schema, layer.partition_columns))
        parts = ", ".join(f"`{c}`" for c in layer.partition_columns)
        clustered = ""
        if buckets:
            by = ", ".join(f"`{c}`" for c in buckets[1])
            clustered = f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets[0]} BUCKETS "
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {layer.qualified_name} ({columns}) USING parquet "
            f"PARTITIONED BY ({parts}) {clustered}LOCATION {_text(layer.path)}"
        )
    return known is None


def note_columns(spark: SparkSession, layer: Layer, columns: Reconciled) -> None:
    """Let a table have these columns from now on: its readers by path, and the catalog if it knows the table.

    Added columns are added to the catalog table. Spark cannot change the type of a catalog column, so for a wider one the entry
    is dropped and made again over the same files; a reader may miss it in between. No file is rewritten: files of the
    former columns are read with the new ones.
    """
    write_lines(spark, schema_note(layer.path), [columns.schema.json()])
    spark.catalog.refreshByPath(layer.path)
    if layer.qualified_name is None or registered_location(spark, layer) is None:
        return
    known = {f.name: f.dataType for f in spark.table(layer.qualified_name).schema.fields}
    fields = columns.schema.fields
    if any(f.name in known and known[f.name] != f.dataType for f in fields):
        spark.sql(f"DROP TABLE {layer.qualified_name}")
        register_table(spark, layer, columns.schema)
        return
    new = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields if f.name not in known)
    if new:
        spark.sql(f"ALTER TABLE {layer.qualified_name} ADD COLUMNS ({new})")
        spark.catalog.refreshTable(layer.qualified_name)


def register_table(
    spark: SparkSession, layer: Layer, schema: T.StructType, partitions: Sequence[Row] | None = None
) -> bool:
    """Register the layer if it is missing, then let the catalog know its partitions.

    ``partitions`` names those that the last load wrote. Without it, for a new table, or if one of
    them is the NULL partition, all folders of the table are listed instead.

    Safe to run after every load. Returns whether the table was new.
    """
    new = create_table(spark, layer, schema)
    if new or partitions is None or any(None in tuple(p) for p in partitions):
        spark.sql(f"MSCK REPAIR TABLE {layer.qualified_name}")
    else:
        _add_partitions(spark, layer, partitions)
    spark.catalog.refreshTable(layer.qualified_name)
    return new
