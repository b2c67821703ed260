"""Keyed upsert of one DataFrame into another, without a transactional table format.

Semantics are those of ``MERGE ... WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN
INSERT *``: every target row whose key is in the source takes the source row's values, target
rows without a match stay, source rows without a match are added. The source must hold each key
once. Keys compare with ``=``, so NULL never matches, but for those in ``nullable_keys``, which
compare with ``<=>``.

The work is a left join and an anti join, not a full outer join: Spark never broadcasts a full
outer join and cannot split a skewed partition of one, but does both for these.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SOURCE = "__s_"
_TARGET = "__t_"
_FOUND = "__found"


def _prefixed(rows: DataFrame, columns: Sequence[str], prefix: str) -> DataFrame:
    return rows.select(*[F.col(c).alias(prefix + c) for c in columns])


def _same_key(keys: Sequence[str], nullable_keys: Sequence[str], left: str, right: str) -> Column:
    def equal(key: str) -> Column:
        a, b = F.col(left + key), F.col(right + key)
        return a.eqNullSafe(b) if key in nullable_keys else a == b

    return reduce(lambda a, b: a & b, [equal(key) for key in keys])


def check_columns(target: DataFrame, source: DataFrame) -> None:
    """Every target column must be in the source with the same type; extra ones are ignored."""
    have = {f.name: f.dataType for f in source.schema.fields}
    for f in target.schema.fields:
        if f.name not in have:
            raise ValueError(f"merge source lacks column {f.name!r}")
        if have[f.name] != f.dataType:
            raise ValueError(
                f"column {f.name!r} is {f.dataType.simpleString()} in the target "
                f"but {have[f.name].simpleString()} in the source"
            )


def _join_source(
    target: DataFrame, source: DataFrame, keys: Sequence[str], nullable_keys: Sequence[str], how: str
) -> DataFrame:
    marked = _prefixed(source, target.columns, _SOURCE).withColumn(_FOUND, F.lit(True))
    return target.join(marked, _same_key(keys, nullable_keys, "", _SOURCE), how)


def updated_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], nullable_keys: Sequence[str] = ()) -> DataFrame:
    """The matched branch: one row with the source's values per matching target row."""
    joined = _join_source(target, source, keys, nullable_keys, "inner")
    return joined.select(*[F.col(_SOURCE + c).alias(c) for c in target.columns])


def retained_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], nullable_keys: Sequence[str] = ()) -> DataFrame:
    """Target rows that no source row matches."""
    return target.join(_prefixed(source, keys, _SOURCE), _same_key(keys, nullable_keys, "", _SOURCE), "left_anti")


def inserted_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    nullable_keys: Sequence[str] = (),
    small_source: bool = False,
) -> DataFrame:
    """The not-matched branch: source rows whose key the target lacks.

    Target keys are made distinct before they are shuffled, so a key that many target rows share
    travels once per partition. With ``small_source`` they are first reduced to those in the
    source; Spark broadcasts a source below its size threshold, and the target is not shuffled.
    """
    present = target.select(*keys)
    if small_source:
        present = present.join(_prefixed(source, keys, _SOURCE), _same_key(keys, nullable_keys, "", _SOURCE), "left_semi")
    present = _prefixed(present.distinct(), keys, _TARGET)
    return source.select(*target.columns).join(present, _same_key(keys, nullable_keys, "", _TARGET), "left_anti")


def merge_frames(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    nullable_keys: Sequence[str] = (),
    small_source: bool = False,
) -> DataFrame:
    """The target after the upsert."""
    check_columns(target, source)
    joined = _join_source(target, source, keys, nullable_keys, "left")
    kept = joined.select(
        *[F.when(F.col(_FOUND), F.col(_SOURCE + c)).otherwise(F.col(c)).alias(c) for c in target.columns]
    )
    return kept.unionByName(inserted_rows(target, source, keys, nullable_keys, small_source))
