"""Rounding rules.

Three rules exist side by side because the star, bucket and graph models were
defined on engines that round differently:

* ``half_up``     decimal half-up: on DECIMAL exactly, on DOUBLE by its shortest text
* ``half_even``   ties-to-even decided on the exact binary value of a double
* ``scaled_even`` ties-to-even decided on the scaled double (scale, rint, unscale)
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(value: Column, digits: int) -> Column:
    return F.round(value, digits).cast("double")


def whole_half_up(value: Column) -> Column:
    """``round(value)`` of a double as a whole number; from 1 to 2^50 without its way over text.

    There adding a half is exact, or ends below the next whole number.
    """
    plain = value.between(1.0, float(2 ** 50))
    return F.when(plain, F.floor(value + 0.5)).otherwise(F.round(value).cast("long"))


def scaled_even(value: Column, digits: int) -> Column:
    scale = F.lit(float(10 ** digits))
    return F.rint(value * scale) / scale


def half_even(value: Column, digits: int) -> Column:
    """Round a double to ``digits`` places, ties decided without floating-point noise.

    ``value * scale`` is split into the rounded product and its exact error
    (Dekker's product with Veltkamp's split), so the comparison with one half
    sees the true product. Valid for scales below 2**26.
    """
    if not 0 <= digits <= 7:
        raise ValueError("digits must be between 0 and 7")
    scale = F.lit(float(10 ** digits))
    x = value.cast("double")
    split = x * F.lit(134217729.0)
    high = split - (split - x)
    low = x - high
    product = x * scale
    error = (high * scale - product) + low * scale
    floor = F.floor(product).cast("double")
    over_half = ((product - floor) - F.lit(0.5)) + error
    odd = F.pmod(floor, F.lit(2.0)) == 1.0
    step = F.when((over_half > 0) | ((over_half == 0) & odd), F.lit(1.0)).otherwise(F.lit(0.0))
    return (floor + step) / scale


def exact_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient of two whole numbers as DECIMAL with 16 places, free of binary noise."""
    return numerator.cast("decimal(22,0)") / denominator.cast("decimal(18,0)")


def exact_mean(rate: Column) -> Column:
    """Mean of a DECIMAL(12,4) column with 16 places (plain ``avg`` keeps only 8)."""
    return F.sum(rate).cast("decimal(26,4)") / F.count(rate).cast("decimal(16,0)")


def rate_units(rate: Column) -> Column:
    """A rate with four decimals as a whole number of 1/10000; sums of it are exact."""
    return F.round(rate * F.lit(10000.0)).cast("long")


def mean_of_units(units: Column, count: Column) -> Column:
    """Mean rate from an exact sum of ``rate_units``."""
    return (units / F.lit(10000.0)) / count
