"""Calendar attributes of an integer week ``YYYYWW``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month names in calendar order.
MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
# Months of the two seasonal flags.
SUMMER_MONTHS = [6, 7, 8]
FLU_MONTHS = [10, 11, 12, 1, 2, 3]


def _floor_div(value: Column, by: int) -> Column:
    return ((value - F.pmod(value, F.lit(by))) / by).cast("int")


def week_of(epi_week: Column) -> Column:
    return F.pmod(epi_week, F.lit(100))


def year_of(epi_week: Column) -> Column:
    return _floor_div(epi_week, 100)


def month_of(epi_week: Column) -> Column:
    """Month 1..12 from the week number; week 53 stays in December, week 0 in January."""
    raw = F.floor((week_of(epi_week) - 1) * 12 / 52).cast("int") + 1
    return F.least(F.greatest(raw, F.lit(1)), F.lit(12))


def month_name_of(month: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in MONTH_NAMES]), month.cast("int"))


def quarter_of(month: Column) -> Column:
    return F.floor((month - 1) / 3).cast("int") + 1


def decade_of(year: Column) -> Column:
    return (year - F.pmod(year, F.lit(10))).cast("int")


def month_index(year: Column, month: Column) -> Column:
    """Consecutive month number; differences of it are month lags."""
    return year * 12 + month


def with_year_month(df: DataFrame, week: str = "epi_week") -> DataFrame:
    return df.withColumns({
        "week_number": week_of(F.col(week)),
        "year": year_of(F.col(week)),
        "month": month_of(F.col(week)),
    })


def with_time_fields(df: DataFrame, week: str = "epi_week") -> DataFrame:
    return with_year_month(df, week).withColumns({
        "month_name": month_name_of(F.col("month")),
        "quarter": quarter_of(F.col("month")),
        "decade": decade_of(F.col("year")),
        "century": _floor_div(F.col("year"), 100),
        "is_summer": F.col("month").isin(SUMMER_MONTHS),
        "is_flu_season": F.col("month").isin(FLU_MONTHS),
    })


def week_start(epi_week: Column) -> Column:
    """First day of the week as a timestamp: 1 January plus seven days per week number."""
    start = F.make_date(year_of(epi_week), F.lit(1), F.lit(1))
    return F.date_add(start, ((week_of(epi_week) - 1) * 7).cast("int")).cast("timestamp")
