"""Expressions over arrays of structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseloom.functions.guards import one_if_zero
from caseloom.functions.rounding import half_up


def total_of(items: Column, field: str) -> Column:
    """Sum of one field over an array of structs."""
    return F.aggregate(items, F.lit(0).cast("long"), lambda acc, item: acc + item[field])


def share_profile(items: Column, name: str, amount: str, digits: int) -> Column:
    """Map an array of (name, amount) structs to (name, pct of the array total)."""
    total = one_if_zero(total_of(items, amount))
    return F.transform(items, lambda item: F.struct(
        item[name].alias(name),
        half_up(item[amount].cast("double") / total * 100, digits).alias("pct"),
    ))


def has_at_least(items: Column, n: int) -> Column:
    return F.size(items) >= n


def first_of(items: Column) -> Column:
    """First element, null for an empty or null array."""
    return F.get(items, F.lit(0))
