"""Text normalisation and text-to-value conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as white space when trimming.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0        "
    "        　"
)
# Texts that a CSV cell may hold in place of a missing value.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def trimmed(value: Column) -> Column:
    return F.btrim(value, F.lit(WHITESPACE))


def tidy(value: Column) -> Column:
    return F.upper(trimmed(value))


def number_or_null(value: Column) -> Column:
    """Numeric text as double, anything else null; ``10d`` and ``NaN`` are not numbers."""
    text = value.cast("string")
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def missing_to_null(value: Column) -> Column:
    return F.when(~value.isin(MISSING_TOKENS), value)


def true_text(value: Column) -> Column:
    """``true`` in any case is true; everything else, null included, is false."""
    return F.coalesce(F.lower(value.cast("string")) == "true", F.lit(False))


def neighbour_list(value: Column) -> Column:
    return F.split(F.btrim(value), r"\s+")
