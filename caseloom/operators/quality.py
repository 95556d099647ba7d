"""Data-quality checks over raw rows and over the loaded tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom import schemas
from caseloom.functions.rounding import half_even
from caseloom.functions.text import trimmed

# Texts that count as whole and as negative numbers, issues and pass mark.
INT_PATTERN = r"^[+-]?\d+(_\d+)*$"
NEGATIVE_PATTERN = r"^-[0_]*[1-9]"
ISSUES = ["null_cases", "negative_cases", "invalid_state", "invalid_disease",
          "invalid_epi_week", "null_disease"]
PASS_MARK = 95.0


def missing_columns(columns: Sequence[str], required: Sequence[str] = schemas.RAW_COLUMNS) -> list[str]:
    return sorted(set(required) - set(columns))


def column_report(df: DataFrame, required: Sequence[str] = schemas.RAW_COLUMNS,
                  absent: Sequence[str] = ()) -> DataFrame:
    """One row per required column: is it there, and in how many rows is it filled.

    ``absent`` names columns that some file of the data set lacks; they are not present.
    """
    missing = sorted({*missing_columns(df.columns, required), *absent})
    filled = [F.count(F.col(c)) if c in df.columns else F.lit(0).cast("long") for c in required]
    counted = df.agg(F.count("*").alias("total_rows"),
                     *[n.alias(c) for n, c in zip(filled, required)])
    rows = counted.unpivot(["total_rows"], list(required), "column_name", "filled_rows")
    return rows.withColumn("present", ~F.col("column_name").isin(missing))


def _members(reference: DataFrame, column: str, name: str) -> DataFrame:
    return reference.select(F.col(column).alias(name)).distinct().withColumn(f"known_{name}", F.lit(True))


def checked_rows(raw: DataFrame, regions: DataFrame, diseases: DataFrame) -> DataFrame:
    """Raw text rows with one 0/1 column per issue and the values that count as found."""
    text = raw.select(*[F.coalesce(trimmed(F.col(c).cast("string")), F.lit("")).alias(c)
                        for c in ("disease", "state", "cases", "epi_week")])
    rows = (text.join(_members(diseases, "disease_name", "disease"), "disease", "left")
            .join(_members(regions, "state_code", "state"), "state", "left"))
    whole_cases = F.col("cases").rlike(INT_PATTERN)
    week_text = F.regexp_replace("epi_week", "_", "")
    week = F.when(F.col("epi_week").rlike(INT_PATTERN), week_text.try_cast("long"))
    year = F.floor(week / 100)
    good_week = F.coalesce(
        F.pmod(week, F.lit(100)).between(1, 53) & year.between(1800, 2100), F.lit(False))
    no_disease = F.col("disease") == ""
    known_disease = F.col("known_disease").isNotNull() & ~no_disease
    known_state = F.col("known_state").isNotNull()
    flags = {
        "null_cases": ~whole_cases,
        "negative_cases": whole_cases & F.col("cases").rlike(NEGATIVE_PATTERN),
        "invalid_state": ~known_state,
        "invalid_disease": ~no_disease & ~known_disease,
        "invalid_epi_week": ~good_week,
        "null_disease": no_disease,
    }
    return rows.select(
        *[flag.cast("int").alias(name) for name, flag in flags.items()],
        F.when(known_disease, F.col("disease")).alias("found_disease"),
        F.when(known_state, F.col("state")).alias("found_state"),
        F.when(good_week, year.cast("int")).alias("found_year"))


def issue_counts(raw: DataFrame, regions: DataFrame, diseases: DataFrame) -> DataFrame:
    """One row: total rows, one counter per issue, what was found, score and verdict.

    A row may count for several issues. No rows at all is a failure with score 0. The
    values found are counted as sets: they are members of a reference table, which bounds
    the sets, and two distinct counts would triple the rows before the shuffle.
    """
    rows = checked_rows(raw, regions, diseases)
    counted = rows.agg(
        F.count("*").alias("total_rows"),
        *[F.coalesce(F.sum(name), F.lit(0)).cast("long").alias(name) for name in ISSUES],
        F.size(F.collect_set("found_disease")).cast("long").alias("diseases_found"),
        F.size(F.collect_set("found_state")).cast("long").alias("states_found"),
        F.min("found_year").alias("first_year"), F.max("found_year").alias("last_year"))
    issues = F.lit(0).cast("long")
    for name in ISSUES:
        issues = issues + F.col(name)
    share = 1 - issues / F.nullif(F.col("total_rows"), F.lit(0))
    score = F.coalesce(half_even(share * 100, 2), F.lit(0.0))
    return (counted.withColumn("total_issues", issues).withColumn("quality_score", score)
            .withColumn("passed", (F.col("total_rows") > 0) & (F.col("quality_score") >= PASS_MARK)))


def found_values(raw: DataFrame, regions: DataFrame, diseases: DataFrame) -> DataFrame:
    """The distinct valid diseases and states and the year range, as one row.

    Both sets hold members of a reference table only, so that table bounds their size.
    """
    rows = checked_rows(raw, regions, diseases)
    return rows.agg(
        F.sort_array(F.collect_set("found_disease")).alias("diseases"),
        F.sort_array(F.collect_set("found_state")).alias("states"),
        F.min("found_year").alias("first_year"), F.max("found_year").alias("last_year"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row; empty when the uniqueness rule holds."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter(F.col("row_count") > 1)


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key is set but not in the parent; empty when the reference holds."""
    return child.filter(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (column_name, null_count) for columns that must not be null; one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column_name", "null_count")


class IntegrityError(ValueError):
    """A loaded or reference table breaks a key rule."""


def broken_keys(frames: Mapping[str, DataFrame], rules: Mapping[str, Sequence[str]],
                shown: int = 5) -> list[str]:
    """A line per table whose key is not unique, with some of the repeated keys."""
    found = []
    for name, keys in rules.items():
        repeated = [tuple(r)[:-1] for r in duplicate_keys(frames[name], keys).limit(shown).collect()]
        if repeated:
            found.append(f"{name}: {', '.join(keys)} not unique: {sorted(map(str, repeated))}")
    return found


def lost_keys(child: DataFrame, parents: Mapping[str, DataFrame], shown: int = 5) -> list[str]:
    """A line per foreign key with values that its table lacks."""
    found = []
    for key, parent in parents.items():
        lost = [r[0] for r in orphans(child, parent, key).select(key).distinct().limit(shown).collect()]
        if lost:
            found.append(f"{key} without its row: {sorted(lost)}")
    return found


# Keys of the reference tables and of the graph's nodes, integrity rules of the star.
REFERENCE_KEYS = {
    "regions": ["state_code"], "diseases": ["disease_name"], "populations": ["state_code", "decade"],
}
NODE_KEYS = {"Disease": ["name"], "State": ["code"], "Region": ["name"], "City": ["state_code", "name"]}
UNIQUE_KEYS = {
    "dim_time": ["epi_week"],
    "dim_location": ["city_name", "state_code", "loc_type"],
    "dim_disease": ["disease_name"],
    "fact": ["incidence_key"],
    "mv_monthly_disease_state": ["disease_name", "state_name", "year", "month"],
}
REQUIRED_COLUMNS = {
    "dim_time": ["time_key", "epi_week", "week_number", "month", "month_name", "quarter", "year",
                 "decade", "century", "is_summer", "is_flu_season"],
    "dim_location": ["location_key", "state_code", "state_name", "census_region",
                     "census_division", "loc_type"],
    "dim_disease": ["disease_key", "disease_name", "disease_category", "transmission_type",
                    "is_vaccine_preventable"],
    "fact": ["incidence_key", "time_key", "location_key", "disease_key", "case_count"],
}
FOREIGN_KEYS = {"time_key": "dim_time", "location_key": "dim_location", "disease_key": "dim_disease"}
