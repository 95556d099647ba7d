"""Partial states of the star's summaries: what can be kept per decade and merged upward.

The state per place and month holds sums, counts and the maximum; means are divided last. The
sketches hold which states and places reported, and merge where distinct counts cannot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.operators.models import Buckets, Star

MONTH = ("decade", "year", "month", "month_name")


def _in_decades(df: DataFrame, decades: Sequence[int] | None) -> DataFrame:
    return df if decades is None else df.filter(F.col("decade").isin(*decades))


def place_months(star: Star, decades: Sequence[int] | None = None) -> DataFrame:
    """Sums, counts and the highest week per disease, place and month of both grains.

    With ``decades`` only their partitions of the fact are read.
    """
    fact = _in_decades(star.fact, decades)
    weeks = star.times.select("time_key", "month", "month_name")
    return (fact.join(weeks, "time_key")
            .groupBy("disease_key", "location_key", "loc_type", *MONTH).agg(
                F.sum("case_count").alias("cases"), F.sum("incidence_rate").alias("rates"),
                F.count("incidence_rate").alias("n"), F.max("case_count").alias("peak"),
                F.count("*").alias("records")))


def _rate():
    return (F.sum("rates").cast("decimal(26,4)") / F.sum("n").cast("decimal(16,0)")).alias("avg_incidence_rate")


def monthly_disease_state(states: DataFrame, star: Star) -> DataFrame:
    """As the summary of that name, with ``decade``, from the partial states."""
    places = star.dim_location.select("location_key", "state_name", "census_region")
    return (states.filter(F.col("loc_type") == "STATE").join(star.diseases, "disease_key")
            .join(places, "location_key")
            .groupBy("disease_name", "state_name", "census_region", *MONTH)
            .agg(F.sum("cases").alias("total_cases"), _rate(), F.sum("records").alias("record_count")))


def yearly_disease_region(states: DataFrame, star: Star) -> DataFrame:
    """As the summary of that name, from the partial states; one row per place and year first."""
    per_place = (states.filter(F.col("loc_type") == "STATE")
                 .groupBy("disease_key", "location_key", "year", "decade")
                 .agg(F.sum("cases").alias("cases"), F.sum("rates").alias("rates"), F.sum("n").alias("n"),
                      F.max("peak").alias("peak")))
    return (per_place.join(star.diseases, "disease_key")
            .join(star.dim_location.select("location_key", "census_region"), "location_key")
            .groupBy("disease_name", "disease_category", "census_region", "year", "decade")
            .agg(F.sum("cases").alias("total_cases"), _rate(), F.max("peak").alias("peak_weekly_cases"),
                 F.count("*").alias("reporting_locations")))


def decade_disease_national(states: DataFrame, star: Star) -> DataFrame:
    """As the summary of that name, from the partial states."""
    city_cases = F.sum(F.when(F.col("loc_type") == "CITY", F.col("cases")).otherwise(0))
    per_place = states.groupBy("disease_key", "location_key", "loc_type", "decade").agg(
        F.sum("cases").alias("cases"), F.sum("rates").alias("rates"), F.sum("n").alias("n"))
    return (per_place.join(star.dim_location.select("location_key", "state_code"), "location_key")
            .join(star.diseases, "disease_key").groupBy("disease_name", "decade")
            .agg(F.sum("cases").alias("total_cases"), _rate(),
                 F.count_distinct("state_code").alias("states_reporting"),
                 city_cases.alias("cases_reported_at_city_grain")))


def yearly_disease_city(states: DataFrame, star: Star) -> DataFrame:
    """As the summary of that name, with ``decade``, from the partial states."""
    places = star.dim_location.filter(F.col("loc_type") == "CITY").select(
        "location_key", "city_name", "state_code")
    return (states.filter(F.col("loc_type") == "CITY").join(places, "location_key")
            .join(star.diseases, "disease_key")
            .groupBy("disease_name", "city_name", "state_code", "year", "decade")
            .agg(F.sum("cases").alias("total_cases"), _rate()))


FROM_STATES = {
    "mv_monthly_disease_state": monthly_disease_state,
    "mv_yearly_disease_region": yearly_disease_region,
    "mv_decade_disease_national": decade_disease_national,
    "mv_yearly_disease_city": yearly_disease_city,
}


def place_sketches(states: DataFrame, star: Star) -> DataFrame:
    """Mergeable sketches of the states and places that report, per disease, region, grain and month."""
    places = star.dim_location.select("location_key", "state_code", "census_region")
    return (states.select("disease_key", "location_key", "loc_type", "decade", "year", "month")
            .join(places, "location_key").join(star.diseases.select("disease_key", "disease_name"), "disease_key")
            .groupBy("disease_name", "census_region", "loc_type", "decade", "year", "month")
            .agg(F.hll_sketch_agg("state_code").alias("states"),
                 F.hll_sketch_agg("location_key").alias("places")))


def bucket_sketches(buckets: Buckets) -> DataFrame:
    """Mergeable sketches of the states that report, per disease, region and month of the buckets."""
    return (buckets.summaries().groupBy(
        F.col("disease.name").alias("disease"), F.col("location.region").alias("region"), "decade",
        F.col("time_bucket.year").alias("year"), F.col("time_bucket.month").alias("month"))
        .agg(F.hll_sketch_agg("location.state_code").alias("states")))


def estimated(sketches: DataFrame, *keys: str, of: str = "states") -> DataFrame:
    """(keys, estimate): the approximate number of distinct values behind the merged sketches.

    Any coarser keys will do: months merge to years, decades or the whole table without a
    look at the fact. The relative standard error is about 1.6 percent; few values are exact.
    """
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg(of)).alias("estimate"))
