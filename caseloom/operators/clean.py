"""Cleaning of raw observations. All three models are built from its output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.functions import rounding
from caseloom.functions.guards import null_if_zero
from caseloom.functions.text import missing_to_null, number_or_null, tidy

# Columns without which a raw row is dropped.
REQUIRED = ["cases", "disease", "state", "epi_week", "loc_type"]


def missing_cells(raw: DataFrame) -> DataFrame:
    """Raw text rows with cells that hold a missing-value token made null."""
    return raw.select(*[missing_to_null(F.col(c)).alias(c) for c in raw.columns])


def drop_incomplete(raw: DataFrame) -> DataFrame:
    return raw.na.drop(subset=REQUIRED)


def positive_cases(df: DataFrame) -> DataFrame:
    """Numeric, positive case counts, truncated: 0.5 passes the filter and becomes 0."""
    number = number_or_null(F.col("cases"))
    return df.withColumn("cases", number).filter(F.col("cases") > 0).withColumn(
        "cases", F.col("cases").cast("int"))


def normalised_text(df: DataFrame) -> DataFrame:
    """Trimmed upper-case names; a missing place becomes the text NAN."""
    return df.withColumns({
        "disease": tidy(F.col("disease")),
        "state": tidy(F.col("state")),
        "loc_type": tidy(F.col("loc_type")),
        "loc": F.coalesce(tidy(F.col("loc")), F.lit("NAN")),
    })


def numeric_rate(df: DataFrame) -> DataFrame:
    rate = F.coalesce(number_or_null(F.col("incidence_per_100000")), F.lit(0.0))
    return df.withColumn("incidence_per_100000", rate)


def clean_observations(raw: DataFrame) -> DataFrame:
    """All cleaning steps. Weeks that are not numbers are dropped; ``dropped_rows`` counts them."""
    df = numeric_rate(normalised_text(positive_cases(drop_incomplete(missing_cells(raw)))))
    week = number_or_null(F.col("epi_week")).cast("int")
    return df.withColumn("epi_week", week).na.drop(subset=["epi_week"]).select(
        "epi_week", "state", "loc", "disease", "cases", "incidence_per_100000", "loc_type")


def dropped_rows(raw: DataFrame) -> DataFrame:
    """One row: rows read, and rows that cleaning drops for each reason, the first that holds."""
    rows = missing_cells(raw)
    incomplete = F.lit(False)
    for column in REQUIRED:
        incomplete = incomplete | F.col(column).isNull()
    cases = number_or_null(F.col("cases"))
    no_cases = ~incomplete & ~F.coalesce(cases > 0, F.lit(False))
    no_week = ~incomplete & ~no_cases & number_or_null(F.col("epi_week")).isNull()
    return rows.agg(F.count("*").alias("rows_read"), F.count_if(incomplete).alias("incomplete"),
                    F.count_if(no_cases).alias("no_positive_cases"),
                    F.count_if(no_week).alias("week_not_a_number"))


def typed_observations(rows: DataFrame) -> DataFrame:
    """The same cleaning for rows that already carry numeric types (no text parsing)."""
    df = normalised_text(drop_incomplete(rows).filter(F.col("cases") > 0))
    return df.select(
        F.col("epi_week").cast("int").alias("epi_week"), "state", "loc", "disease",
        F.col("cases").cast("int").alias("cases"),
        F.coalesce(F.col("incidence_per_100000").cast("double"), F.lit(0.0))
        .alias("incidence_per_100000"), "loc_type")


def rows_by_grain(df: DataFrame) -> DataFrame:
    return df.groupBy("loc_type").agg(F.count("*").alias("row_count"))


def incidence_per_100k(df: DataFrame, cases: str, population: str) -> DataFrame:
    """Adds ``incidence``: cases per 100 000 with four decimals, 0 without population."""
    people = F.col(population)
    rate = F.col(cases) * F.lit(100000.0) / null_if_zero(people)
    return df.withColumn("incidence", F.when(
        people > 0, rounding.half_even(rate, 4)).otherwise(F.lit(0.0)))
