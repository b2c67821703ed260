"""Duplicate removal and the check for duplicate merge keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """A merge source holds several rows for one key."""


def any_per_key(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key; which one is not defined. NULLs count as equal."""
    return rows.dropDuplicates(list(keys))


def as_sortable(columns: Sequence[str], keys: Sequence[str], order: Sequence[str]) -> Column:
    """A struct of all non-key columns, those of ``order`` first. Structs compare field by field.

    A key column in ``order`` is constant per key and so left out. The others follow by name, so
    that a table read back with its columns in another order breaks ties the same way.
    """
    leading = [c for c in order if c not in keys]
    return F.struct(*leading, *sorted(set(columns) - set(keys) - set(leading)))


def first_per_key(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str] = (), descending: bool = False
) -> DataFrame:
    """The first row per key in ``order``, or the last if ``descending``; NULLs count as equal keys.

    All remaining columns follow as tie-breakers, so the result is the same on every run. NULL
    sorts below all values.

    It is an aggregate, so each input partition sends at most one row per key, and a group is
    never held or sorted as a whole. A key with a large share of the table is no hot spot.
    """
    if set(rows.columns) == set(keys):
        return rows.distinct()
    pick = F.max if descending else F.min
    best = pick(as_sortable(rows.columns, keys, order)).alias("__best")
    return rows.groupBy(*keys).agg(best).select(*keys, "__best.*").select(*rows.columns)


def key_conflicts(rows: DataFrame, keys: Sequence[str], nullable_keys: Sequence[str] = ()) -> DataFrame:
    """Keys held by more than one row, with their row count.

    A NULL in a key not listed in ``nullable_keys`` matches nothing in a merge, so it cannot
    conflict.
    """
    for key in keys:
        if key not in nullable_keys:
            rows = rows.filter(F.col(key).isNotNull())
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("source_rows")).filter("source_rows > 1")


def require_unique(rows: DataFrame, keys: Sequence[str], nullable_keys: Sequence[str] = ()) -> None:
    """Raise if a key occurs more than once."""
    example = key_conflicts(rows, keys, nullable_keys).first()
    if example is not None:
        raise DuplicateKeyError(f"several source rows per merge key {list(keys)}, for example {example.asDict()}")
