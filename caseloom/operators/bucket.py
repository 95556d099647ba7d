"""Bucket model: one nested document per disease, place, year and month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.functions import rounding
from caseloom.functions.epiweek import decade_of, month_name_of, quarter_of, with_year_month
from caseloom.functions.text import true_text
from caseloom.operators.star import conform
from caseloom import schemas

KEYS = ["disease", "state", "loc", "loc_type", "year", "month"]


def _rows(obs: DataFrame) -> DataFrame:
    rate = rounding.scaled_even(F.col("incidence_per_100000"), 4)
    key = F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in KEYS])
    return with_year_month(obs).withColumn("rate", rate).withColumn("bucket_key", key)


def bucket_rows(obs: DataFrame) -> DataFrame:
    """The weekly observations, each with the key of its bucket. No bucket is ever gathered."""
    return conform(_rows(obs).select(
        "bucket_key", "disease", F.col("state").alias("state_code"), "year", "month",
        "epi_week", F.col("week_number").alias("week"), "cases",
        F.col("rate").alias("incidence_rate"), decade_of(F.col("year")).alias("decade")),
        schemas.BUCKET_ROWS)


def documents(buckets: DataFrame, rows: DataFrame) -> DataFrame:
    """The nested documents: every bucket with its weekly observations as an array."""
    weekly = rows.groupBy("bucket_key").agg(F.array_sort(F.collect_list(F.struct(
        "epi_week", "week", "cases", "incidence_rate"))).alias("weekly_observations"))
    return conform(buckets.join(weekly, "bucket_key"), schemas.DOCUMENTS)


def build_buckets(obs: DataFrame, regions: DataFrame, diseases: DataFrame) -> DataFrame:
    """One row per bucket, summarised. Unknown diseases and states stay, with default attributes."""
    grouped = _rows(obs).groupBy(*KEYS, "bucket_key").agg(
        F.sum("cases").alias("total_cases"),
        F.sum(rounding.rate_units(F.col("rate"))).alias("units"),
        F.max("cases").alias("peak_weekly_cases"), F.count("*").alias("observation_count"))
    kinds = diseases.select(
        F.col("disease_name").alias("disease"), "disease_category", "transmission_type",
        true_text(F.col("is_vaccine_preventable")).alias("preventable"), "vaccine_intro_year")
    places = regions.withColumnRenamed("state_code", "state")
    rows = grouped.join(kinds, "disease", "left").join(places, "state", "left")
    mean = rounding.half_even(
        rounding.mean_of_units(F.col("units"), F.col("observation_count")), 4)
    decade = decade_of(F.col("year"))
    summary = F.struct(
        F.col("total_cases"), mean.alias("avg_incidence_rate"),
        F.col("peak_weekly_cases"), F.col("observation_count"))
    return conform(rows.select(
        F.struct(
            F.col("disease").alias("name"),
            F.coalesce("disease_category", F.lit("")).alias("category"),
            F.coalesce("transmission_type", F.lit("")).alias("transmission"),
            F.coalesce("preventable", F.lit(False)).alias("vaccine_preventable"),
            F.col("vaccine_intro_year").alias("vaccine_year")).alias("disease"),
        F.struct(
            F.when(F.col("loc_type") == "CITY", F.col("loc")).alias("city"),
            F.col("state").alias("state_code"),
            F.coalesce("state_name", "state").alias("state_name"),
            F.coalesce("census_region", F.lit("")).alias("region"),
            F.coalesce("census_division", F.lit("")).alias("division"),
            F.col("loc_type"),
            F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lng"))
            .alias("coordinates")).alias("location"),
        F.struct(
            F.col("year"), F.col("month"), month_name_of(F.col("month")).alias("month_name"),
            quarter_of(F.col("month")).alias("quarter"), decade.alias("decade"))
        .alias("time_bucket"),
        summary.alias("monthly_summary"), "bucket_key", decade.alias("decade")), schemas.BUCKETS)
