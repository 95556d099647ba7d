"""Division guards. Each query variant names the guard its model is defined with."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_if_zero(value: Column) -> Column:
    return F.nullif(value, F.lit(0))


def one_if_zero(value: Column) -> Column:
    return F.when(value == 0, F.lit(1)).otherwise(value)


def at_least_one(value: Column) -> Column:
    return F.greatest(F.lit(1), value)


def when_usable(value: Column, result: Column) -> Column:
    """``result`` where ``value`` is neither null nor zero, else null."""
    return F.when(value.isNotNull() & (value != 0), result)
