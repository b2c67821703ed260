"""Sums of doubles that no order of the rows can change, as SQL expressions.

A finite double is a whole number times a power of two. Numbers whose powers lie in the same range of eight share a bin, with
one unit for all: there each is a whole number below 2^62, and their sum is a decimal without places. Sums of bins are exact and can be
added and subtracted, whatever the size of the numbers. Only a total is rounded.

The functions take and give SQL text, since expressions of this size take Python longer to build than Spark to run.
"""

from __future__ import annotations

_WHOLE = "decimal(38,0)"


def _times_power_of_two(value: str, exponent: str) -> str:
    """In two steps, as one factor alone may be too large or too small for a double."""
    return f"{value} * pow(2D, floor(({exponent}) / 2)) * pow(2D, ({exponent}) - floor(({exponent}) / 2))"


def bin_of(value: str) -> str:
    """The power of two that is the unit of the value's bin; NULL for NULL and what is not finite.

    The logarithm may be off by one beside a power of two, for which there is a bit to spare.
    """
    return (
        f"CASE WHEN {value} = 0 THEN 0 WHEN NOT isnan({value}) AND abs({value}) < double('infinity') "
        f"THEN cast(floor((floor(log2(abs({value}))) - 53) / 8) * 8 AS int) END"
    )


def in_units(value: str, unit: str) -> str:
    """How many units of its bin the value is; exact."""
    return f"cast(cast({_times_power_of_two(value, f'-{unit}')} AS bigint) AS decimal(28,0))"


def _rounded_once(bins: str) -> str:
    """All bins as one whole number of the least unit, rounded when it becomes a double. NULL if it has too many digits."""
    # beyond 16 steps no sum but zero has room; zero needs none
    steps = "sequence(1, cast(least((s.unit - x.unit) div 8, 16) AS int))"
    times = f"(t, i) -> cast(try_multiply(t, cast(256 AS decimal(3,0))) AS {_WHOLE})"
    moved = f"IF(s.total = 0 OR s.unit <= x.unit, s.total, aggregate({steps}, s.total, {times}))"
    start = f"named_struct('unit', 0, 'total', cast(0 AS {_WHOLE}))"
    lower = f"(s, x) -> named_struct('unit', x.unit, 'total', cast(try_add({moved}, x.units) AS {_WHOLE}))"
    rounded = _times_power_of_two("cast(z.total AS double)", "z.unit")
    return f"aggregate(reverse({bins}), {start}, {lower}, z -> {rounded})"


def _smallest_first(bins: str) -> str:
    """Each bin rounded on its own, and added from the least unit on."""
    rounded = _times_power_of_two("cast(x.units AS double)", "x.unit")
    return f"aggregate({bins}, 0D, (t, x) -> t + {rounded})"


def total_of(bins: str) -> str:
    """The sum of an array of ``unit`` and ``units``, one entry per bin and the units in ascending order.

    Rounded once if the bins lie within some 60 powers of two of each other (for fewer than 2^60 numbers), else added smallest first.
    Either depends on nothing but the numbers summed.
    """
    return f"coalesce({_rounded_once(bins)}, {_smallest_first(bins)})"
