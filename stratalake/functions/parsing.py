"""Parsing and casting in which a bad value becomes NULL, also under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_timestamp(value: Column | str) -> Column:
    return F.try_to_timestamp(_column(value))


def parse_date(value: Column | str) -> Column:
    return F.try_to_date(_column(value))


def to_double(value: Column | str) -> Column:
    return _column(value).try_cast("double")


def to_int(value: Column | str) -> Column:
    """Whole number, truncated toward zero. Going through double keeps text such as ``'1.0'``."""
    return to_double(value).try_cast("int")


def exact_amount(value: Column | str) -> Column:
    """An amount as a decimal with ten places, so that a sum does not depend on the order of its rows."""
    return _column(value).try_cast("decimal(38,10)")
