"""Generic slice, dice, drill-down, roll-up and pivot on the star model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.operators.models import Star

# Dimension name -> (table to join, column).
DIMENSIONS = {
    "disease": ("disease", "disease_name"),
    "state": ("location", "state_name"),
    "year": ("time", "year"),
    "decade": ("time", "decade"),
    "region": ("location", "census_region"),
}
# Level -> the next finer and the next coarser one.
FINER = {"decade": "year", "year": "quarter", "quarter": "month", "month": "week"}
COARSER = {"year": "decade", "quarter": "year", "month": "quarter", "week": "month"}
LEVEL_COLUMNS = {"week": "week_number"}
# Pivot columns of the full data set.
PIVOT_DISEASES = ["MEASLES", "PERTUSSIS", "POLIO", "DIPHTHERIA", "HEPATITIS A", "MUMPS",
                  "RUBELLA", "SMALLPOX"]


def _choice(name: str, options: Mapping[str, Any]):
    if name not in options:
        raise ValueError(f"unknown level or dimension {name!r}; options: {list(options)}")
    return options[name]


def _slice_rows(star: Star, dimension: str, value: Any, *extra: str) -> tuple[DataFrame, str]:
    table, column = _choice(dimension, DIMENSIONS)
    rows = star.rows(*{table, *extra}, grain=None, where=F.col(column) == value,
                     years=(int(value), int(value)) if dimension == "year" else None)
    return rows.withColumn("slice_key", F.col(column)), column


def slice_summary(star: Star, dimension: str, value: Any) -> DataFrame:
    """Totals for one value of one dimension, all grains."""
    rows, _ = _slice_rows(star, dimension, value)
    return rows.groupBy("slice_key").agg(
        F.sum("case_count").alias("total_cases"), F.count("*").alias("record_count"))


def slice_breakdown(star: Star, dimension: str, value: Any) -> DataFrame:
    """The same slice by year, all grains."""
    rows, _ = _slice_rows(star, dimension, value, "time")
    return (rows.groupBy("slice_key", "year").agg(F.sum("case_count").alias("total_cases"))
            .orderBy("year"))


def dice(star: Star, values: Mapping[str, Any]) -> DataFrame:
    """State-grain totals under several equalities; names that are no dimension are ignored."""
    known = {name: value for name, value in values.items() if name in DIMENSIONS}
    if not known:
        raise ValueError(f"give a value for at least one of {list(DIMENSIONS)}")
    years = (int(known["year"]),) * 2 if "year" in known else None
    rows = star.rows("disease", "time", "location", years=years)
    for name, value in known.items():
        rows = rows.filter(F.col(DIMENSIONS[name][1]) == value)
    return (rows.groupBy("disease_name", "state_name", "year")
            .agg(F.sum("case_count").alias("total_cases"))
            .orderBy("year", "disease_name", "state_name"))


def drill_down(star: Star, granularity: str, value: int | None = None) -> DataFrame:
    """Totals by disease at a level and the next finer one.

    Quarters, months and weeks carry no year: they pool all years.
    """
    fine = _choice(granularity, FINER)
    coarse_column = LEVEL_COLUMNS.get(granularity, granularity)
    one_year = granularity == "year" and value is not None
    rows = star.rows("disease", "time", years=(value, value) if one_year else None)
    if value is not None:
        rows = rows.filter(F.col(coarse_column) == value)
    return (rows.groupBy("disease_name", F.col(coarse_column).alias(granularity),
                         F.col(LEVEL_COLUMNS.get(fine, fine)).alias(fine))
            .agg(F.sum("case_count").alias("total_cases"))
            .orderBy("disease_name", fine, granularity))


def roll_up(star: Star, granularity: str) -> DataFrame:
    """Totals by disease at the level above ``granularity``."""
    coarse = _choice(granularity, COARSER)
    return (star.rows("disease", "time").groupBy("disease_name", coarse)
            .agg(F.sum("case_count").alias("total_cases")).orderBy("disease_name", coarse))


def pivot(star: Star, diseases: Sequence[str] = tuple(PIVOT_DISEASES)) -> DataFrame:
    """Decades as rows, one 0-filled column per listed disease."""
    wide = (star.rows("disease").groupBy("decade").pivot("disease_name", list(diseases))
            .agg(F.sum("case_count")).na.fill(0))
    names = [F.col(f"`{d}`").alias(d.lower().replace(" ", "_")) for d in diseases]
    return wide.select("decade", *names).orderBy("decade")
