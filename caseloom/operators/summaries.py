"""Summary tables over the star and bucket models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.functions import rounding
from caseloom.operators.models import Buckets, Star


def monthly_disease_state(star: Star) -> DataFrame:
    """Monthly totals by disease and state, state grain."""
    months = star.rows("time").groupBy("disease_key", "location_key", "year", "month", "month_name").agg(
        F.sum("case_count").alias("cases"), F.sum("incidence_rate").alias("rates"),
        F.count("incidence_rate").alias("n"), F.count("*").alias("records"))
    return (months.join(star.diseases, "disease_key")
            .join(star.dim_location.select("location_key", "state_name", "census_region"), "location_key")
            .groupBy("disease_name", "state_name", "census_region", "year", "month", "month_name")
            .agg(F.sum("cases").alias("total_cases"), _merged_rate(),
                 F.sum("records").alias("record_count")))


def yearly_disease_region(star: Star) -> DataFrame:
    """Yearly totals by disease and census region, state grain.

    Grouped per location first, so the distinct count is a plain count of those rows.
    """
    keys = ["disease_name", "disease_category", "census_region", "year", "decade"]
    per_place = star.rows().groupBy("disease_key", "location_key", "year", "decade").agg(
        F.sum("case_count").alias("cases"), F.sum("incidence_rate").alias("rates"),
        F.count("incidence_rate").alias("n"), F.max("case_count").alias("peak"))
    per_place = per_place.join(star.diseases, "disease_key").join(
        star.dim_location.select("location_key", "census_region"), "location_key")
    return per_place.groupBy(*keys).agg(
        F.sum("cases").alias("total_cases"), _merged_rate(),
        F.max("peak").alias("peak_weekly_cases"), F.count("*").alias("reporting_locations"))


def _place_totals(star: Star, *keys: str, grain: str | None = None) -> DataFrame:
    """Fact totals per place and the given keys, so the join with places moves few rows."""
    return star.rows(grain=grain).groupBy("disease_key", "location_key", "loc_type", *keys).agg(
        F.sum("case_count").alias("cases"), F.sum("incidence_rate").alias("rates"),
        F.count("incidence_rate").alias("n"))


def _merged_rate():
    return (F.sum("rates").cast("decimal(26,4)") / F.sum("n").cast("decimal(16,0)")).alias(
        "avg_incidence_rate")


def decade_disease_national(star: Star) -> DataFrame:
    """Decade totals by disease over both grains, with the part reported by cities."""
    city_cases = F.sum(F.when(F.col("loc_type") == "CITY", F.col("cases")).otherwise(0))
    places = star.dim_location.select("location_key", "state_code")
    return (_place_totals(star, "decade").join(places, "location_key")
            .join(star.diseases, "disease_key").groupBy("disease_name", "decade")
            .agg(F.sum("cases").alias("total_cases"), _merged_rate(),
                 F.count_distinct("state_code").alias("states_reporting"),
                 city_cases.alias("cases_reported_at_city_grain")))


def yearly_disease_city(star: Star) -> DataFrame:
    """Yearly totals by disease and city; empty where nothing reports at city grain."""
    places = star.dim_location.filter(F.col("loc_type") == "CITY").select(
        "location_key", "city_name", "state_code")
    return (_place_totals(star, "year", grain="CITY").join(places, "location_key")
            .join(star.diseases, "disease_key")
            .groupBy("disease_name", "city_name", "state_code", "year")
            .agg(F.sum("cases").alias("total_cases"), _merged_rate()))


def _bucket_summary(rows: DataFrame, keys: dict) -> DataFrame:
    rate = F.col("monthly_summary.avg_incidence_rate")
    return rows.groupBy(*[c.alias(name) for name, c in keys.items()]).agg(
        F.sum("monthly_summary.total_cases").alias("total_cases"),
        rounding.mean_of_units(F.sum(rounding.rate_units(rate)), F.count(rate))
        .alias("avg_incidence_rate"),
        F.count_distinct("location.state_code").alias("states_reporting"))


def monthly_by_region(buckets: Buckets, state_only: bool = True) -> DataFrame:
    """Bucket summary per disease, region and month; the refresh job covers all grains."""
    rows = buckets.summaries()
    if state_only:
        rows = rows.filter(F.col("location.loc_type") == "STATE")
    return _bucket_summary(rows, {
        "disease": F.col("disease.name"), "region": F.col("location.region"),
        "year": F.col("time_bucket.year"), "month": F.col("time_bucket.month")})


def decade_national(buckets: Buckets) -> DataFrame:
    """Bucket summary per disease and decade, all grains."""
    return _bucket_summary(buckets.summaries(), {
        "disease": F.col("disease.name"), "decade": F.col("decade")})


def first_match(lookup: DataFrame, key: str, *columns: str) -> DataFrame:
    """One row per key: the smallest of its matches."""
    return lookup.groupBy(key).agg(F.min(F.struct(*columns)).alias("match")).select(key, "match.*")


def weekly_by_region(buckets: Buckets, regions: DataFrame) -> DataFrame:
    """Week-grain regional summary: weekly rows, region looked up from the reference.

    Weeks are summed per state before the lookup, so only the small state totals meet it.
    """
    keys = ["disease", "state_code", "year", "month"]
    per_state = (buckets.weeks().groupBy(*keys)
                 .agg(F.sum("cases").alias("cases"),
                      F.sum(rounding.rate_units(F.col("incidence_rate"))).alias("units"),
                      F.count("*").alias("weeks")).select(*keys, "cases", "units", "weeks"))
    lookup = first_match(regions, "state_code", "census_region")
    rows = per_state.join(lookup, "state_code", "left")
    return (rows.groupBy("disease", "year", "month", F.col("census_region").alias("region"))
            .agg(F.sum("cases").alias("total_cases"),
                 rounding.mean_of_units(F.sum("units"), F.sum("weeks")).alias("avg_incidence"),
                 F.sum("weeks").alias("weeks_reporting")))
