"""Which columns a table has after rows with other columns come, and how such rows are fitted in."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What each type can be widened to without losing a value. Parquet files of the narrower type can be read
# as the wider one.
WIDER = {
    "tinyint": ("smallint", "int", "bigint", "double"),
    "smallint": ("int", "bigint", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
}


class SchemaConflictError(ValueError):
    """Rows have a column whose type the table's cannot be reconciled with."""


@dataclass(frozen=True)
class Reconciled:
    """A table's columns after the change; ``added`` and ``widened`` name what is new."""

    schema: T.StructType
    added: tuple[str, ...] = ()
    widened: tuple[str, ...] = ()

    @property
    def changed(self) -> bool:
        return bool(self.added or self.widened)


def fits(narrow: T.DataType, wide: T.DataType) -> bool:
    """Whether every value of one type is one of the other."""
    if narrow == wide:
        return True
    if isinstance(narrow, T.DecimalType) and isinstance(wide, T.DecimalType):
        return narrow.scale <= wide.scale and narrow.precision - narrow.scale <= wide.precision - wide.scale
    return wide.simpleString() in WIDER.get(narrow.simpleString(), ())


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The one of two types that holds the values of both."""
    return b if fits(a, b) else a if fits(b, a) else None


def reconcile(stored: T.StructType, given: T.StructType, fixed: Sequence[str] = ()) -> Reconciled:
    """The columns of a table that takes in rows of the schema ``given``.

    New columns follow the others, before the ``fixed`` ones, which are those of the partitions and keep their type. A column of
    both gets the wider of its types. Columns that the rows lack stay. Raises where no type holds the values of both.
    Names compare without regard to case, as Spark's do.
    """
    coming = {f.name.lower(): f for f in given.fields}
    fields, widened = [], []
    for f in stored.fields:
        other = coming.pop(f.name.lower(), f)
        kind = wider(f.dataType, other.dataType)
        if kind is None or f.name in fixed and kind != f.dataType:
            kinds = f"{f.dataType.simpleString()} in the table but {other.dataType.simpleString()} in the rows"
            raise SchemaConflictError(f"column {f.name!r} is {kinds}")
        if kind != f.dataType:
            widened.append(f.name)
        fields.append(T.StructField(f.name, kind))
    new = [T.StructField(f.name, f.dataType) for f in coming.values()]
    inner = [f for f in fields if f.name not in fixed]
    outer = [f for f in fields if f.name in fixed]
    return Reconciled(T.StructType(inner + new + outer), tuple(f.name for f in new), tuple(widened))


def aligned(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """``rows`` with exactly the columns of ``schema``: widened, or NULL where they lack one."""
    have = {c.lower(): c for c in rows.columns}

    def column(f: T.StructField) -> Column:
        value = F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None)
        return value.cast(f.dataType).alias(f.name)

    return rows.select([column(f) for f in schema.fields])
