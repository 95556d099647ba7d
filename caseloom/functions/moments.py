"""Means, deviations and correlations from exact integer sums.

Floating-point sums depend on the order in which partitions arrive; these do not. The sums are
DECIMAL, products included, and only the last step divides in double precision.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

WIDE = "decimal(19,0)"


def _sums(window: WindowSpec | None, *terms: Column) -> list[Column]:
    sums = [F.sum(t) for t in terms]
    return [s.over(window) for s in sums] if window is not None else sums


def mean(x: Column, window: WindowSpec | None = None) -> Column:
    """Mean of a whole-number column; null without values."""
    total, n = _sums(window, x.cast(WIDE), F.when(x.isNotNull(), 1).otherwise(0))
    return total.cast("double") / F.nullif(n, F.lit(0))


def deviation(x: Column, window: WindowSpec | None = None, sample: bool = True) -> Column:
    """Standard deviation of a whole-number column, of the sample (null for one value) or the population."""
    wide = x.cast(WIDE)
    total, squares, n = _sums(window, wide, wide * wide, F.when(x.isNotNull(), 1).otherwise(0))
    spread = (n.cast(WIDE) * squares - total * total).cast("double")
    degrees = n - 1 if sample else n
    return F.sqrt(spread / F.nullif(n.cast("double") * degrees, F.lit(0.0)))


def correlation(x: Column, y: Column, window: WindowSpec | None = None) -> Column:
    """Pearson correlation of two whole-number columns; null where either side is constant."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x).cast(WIDE), F.when(both, y).cast(WIDE)
    n, of_a, of_b, aa, bb, ab = _sums(window, F.when(both, 1).otherwise(0), a, b, a * a, b * b, a * b)
    n = n.cast(WIDE)
    spread_a, spread_b = ((n * s2 - s * s).cast("double") for s, s2 in ((of_a, aa), (of_b, bb)))
    joint = (n * ab - of_a * of_b).cast("double")
    return joint / F.nullif(F.sqrt(spread_a) * F.sqrt(spread_b), F.lit(0.0))
