"""The Gold aggregate, in one go or by adding and subtracting parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.config import SUMMARY_KEYS
from stratalake.functions.exact_sum import bin_of, in_units, total_of

#: Amounts below 1e16 are decimals of ten places, and 1e12 of them still have room in a sum. From there on doubles are whole numbers.
_AMOUNT, _AMOUNTS, _UNITS = "decimal(26,10)", "decimal(38,10)", "decimal(38,0)"
_NOT_GONE = "trips <> 0 or decimals <> 0 or units <> 0"
#: What a part counts. Parts of one group and ``unit`` are added field by field.
_CONDITIONS = {
    "trips": "true",
    "amounts": "total_amount IS NOT NULL",
    "nans": "isnan(total_amount)",
    "pluses": "total_amount = double('infinity')",
    "minuses": "total_amount = double('-infinity')",
}
_COUNTS = tuple(_CONDITIONS)
_TOTAL = f"""
    CASE WHEN amounts = 0 THEN NULL
         WHEN nans > 0 OR pluses > 0 AND minuses > 0 THEN double('NaN')
         WHEN pluses > 0 THEN double('infinity')
         WHEN minuses > 0 THEN double('-infinity')
         WHEN size(bins) = 0 THEN cast(decimals AS double)
         ELSE cast(decimals AS double) + {total_of("bins")} END"""


def _sums(decimals: str = "decimals", units: str = "units") -> list[Column]:
    return [
        F.expr(f"coalesce(cast(sum({decimals}) AS {_AMOUNTS}), cast(0 AS {_AMOUNTS})) AS decimals"),
        F.expr(f"coalesce(cast(sum({units}) AS {_UNITS}), cast(0 AS {_UNITS})) AS units"),
    ]


def summary_parts(trips: DataFrame, binary: bool = False, sign: str | None = None) -> DataFrame:
    """Parts of the summary: one row per group and ``unit``, a range of amounts that are summed in binary, or NULL.

    Reads no column besides the partition columns, the payment type and the amount. ``sign``, an expression, is 1 for rows that
    come and -1 for rows that go. Parts are exact, so what is taken away leaves no trace. ``binary`` sums all amounts as the
    doubles that they are, see :mod:`stratalake.functions.exact_sum`; without it only those of 1e16 or more.
    """
    decimal = "NULL" if binary else "total_amount"
    rows = trips.selectExpr(
        *SUMMARY_KEYS,
        "total_amount",
        f"try_cast({decimal} AS {_AMOUNT}) AS decimal",
        *([] if sign is None else [f"{sign} AS sign"]),
    )
    rows = rows.withColumn("unit", F.expr(f"CASE WHEN decimal IS NULL THEN {bin_of('total_amount')} END"))
    units = f"CASE WHEN unit IS NOT NULL THEN {in_units('total_amount', 'unit')} END"
    if sign is None:
        counts = [f"count({c})" if n == "trips" else f"count_if({c})" for n, c in _CONDITIONS.items()]
        sums = _sums("decimal", units)
    else:
        counts = [f"sum(IF({c}, cast(sign AS bigint), 0L))" for c in _CONDITIONS.values()]
        sums = _sums("IF(sign < 0, -decimal, decimal)", f"IF(sign < 0, -{units}, {units})")
    named = [F.expr(f"{count} AS {name}") for name, count in zip(_COUNTS, counts, strict=True)]
    return rows.groupBy(*SUMMARY_KEYS, "unit").agg(*named, *sums).where(_NOT_GONE)


def add_parts(parts: DataFrame) -> DataFrame:
    """Parts of the same group and unit as one. Those in which all rows that came have gone again are left out."""
    counts = [F.sum(c).alias(c) for c in _COUNTS]
    return parts.groupBy(*SUMMARY_KEYS, "unit").agg(*counts, *_sums()).where(_NOT_GONE)


def summary_of_parts(parts: DataFrame) -> DataFrame:
    """Trips and amount collected of each group that has trips; ``parts`` hold each group and unit once."""
    bins = "sort_array(collect_list(CASE WHEN unit IS NOT NULL THEN struct(unit, units) END)) AS bins"
    groups = parts.groupBy(*SUMMARY_KEYS).agg(*(F.sum(c).alias(c) for c in _COUNTS), _sums()[0], F.expr(bins))
    return groups.where("trips > 0").selectExpr(
        *SUMMARY_KEYS, "trips AS total_trips", f"cast({_TOTAL} AS double) AS total_amount_collected"
    )


def monthly_summary(trips: DataFrame, exact: bool | str = True) -> DataFrame:
    """Trips and amount collected per year, month and payment type.

    Groups by the stored partition columns, so a filter on them prunes the scan, and reads no
    column besides the payment type and the amount. No order of the rows can change a total, and no amount is left out. With
    ``exact=True`` amounts below 1e16 count as decimals of ten places and larger ones as they are; ``exact="binary"`` sums
    all of them as the doubles that they are. An amount that is not finite makes its group's total so. ``exact=False`` is
    Spark's own sum of doubles, which depends on the order.
    """
    if not exact:
        return trips.groupBy(*SUMMARY_KEYS).agg(
            F.count(F.lit(1)).alias("total_trips"), F.sum("total_amount").alias("total_amount_collected")
        )
    return summary_of_parts(summary_parts(trips, binary=exact == "binary"))


def preview(rows: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a defined order, for a look at the result."""
    return rows.orderBy(*order).limit(n)
