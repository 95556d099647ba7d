"""Decision queries 1 to 10 on the bucket model. City documents are included."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.functions import guards, moments, rounding
from caseloom.functions.epiweek import month_name_of
from caseloom.operators.models import Buckets
from caseloom.plans.star_queries import first_years_ranked, window_total

NAME = "disease.name"
STATE = "location.state_name"
YEAR = "time_bucket.year"
CASES = "monthly_summary.total_cases"
RATE = "monthly_summary.avg_incidence_rate"


def mean_rate(rate: Column) -> Column:
    """Mean of four-decimal rates, summed exactly."""
    return rounding.mean_of_units(F.sum(rounding.rate_units(rate)), F.count(rate))


def _of(buckets: Buckets, disease: str, first: int | None = None, last: int | None = None) -> DataFrame:
    rows = buckets.summaries().filter(F.col(NAME) == disease)
    if first is not None:
        rows = rows.filter(F.col("decade").between(first - first % 10, last - last % 10)
                           & F.col(YEAR).between(first, last))
    return rows


def q01_bucket(buckets: Buckets) -> DataFrame:
    """Cases by disease and decade; the rate is the mean of monthly means."""
    return (buckets.summaries()
            .groupBy(F.col(NAME).alias("disease_name"), F.col("decade"))
            .agg(F.sum(F.col(CASES)).alias("total_cases"),
                 rounding.half_even(mean_rate(F.col(RATE)), 2).alias("avg_incidence"))
            .orderBy("disease_name", "decade"))


def q02_bucket(buckets: Buckets, year: int = 1960, disease: str = "MEASLES") -> DataFrame:
    return (_of(buckets, disease, year, year).groupBy(F.col(STATE).alias("state_name"))
            .agg(F.sum(F.col(CASES)).alias("total_cases"),
                 rounding.half_even(mean_rate(F.col(RATE)), 2).alias("avg_incidence"))
            .orderBy(F.desc("total_cases"), "state_name"))


def q03_bucket(buckets: Buckets, disease: str = "MEASLES", start_year: int = 1950,
               end_year: int = 1970, k: int = 10) -> DataFrame:
    return (_of(buckets, disease, start_year, end_year).groupBy(F.col(STATE).alias("state_name"))
            .agg(F.sum(F.col(CASES)).alias("total_cases"))
            .orderBy(F.desc("total_cases"), "state_name").limit(k))


def q04_bucket(buckets: Buckets, disease: str = "MEASLES") -> DataFrame:
    """Mean weekly cases per calendar month, over the weekly observations."""
    weeks = buckets.weeks().filter(F.col("disease") == disease)
    return (weeks.groupBy("month").agg(rounding.half_even(F.avg("cases"), 2).alias("avg_weekly_cases"))
            .select("month", month_name_of(F.col("month")).alias("month_name"), "avg_weekly_cases")
            .orderBy("month"))


def q05_bucket(buckets: Buckets, disease: str = "MEASLES") -> DataFrame:
    yearly = (_of(buckets, disease)
              .groupBy(F.col(STATE).alias("state_name"), F.col(YEAR).alias("year"))
              .agg(F.sum(F.col(CASES)).alias("total_cases")))
    previous = F.lag("total_cases").over(Window.partitionBy("state_name").orderBy("year"))
    prev = F.col("prev_year_cases")
    change = (F.col("total_cases") - prev) / prev * 100
    return (yearly.withColumn("prev_year_cases", previous)
            .withColumn("yoy_pct_change", guards.when_usable(prev, rounding.half_even(change, 2)))
            .orderBy("state_name", "year"))


def _busy_state_years(buckets: Buckets, floor: int) -> DataFrame:
    return (buckets.summaries()
            .groupBy(F.col("location.state_code").alias("state"), F.col(YEAR).alias("year"),
                     F.col(NAME).alias("disease"))
            .agg(F.sum(F.col(CASES)).alias("total_cases")).filter(F.col("total_cases") > floor))


def q06_bucket(buckets: Buckets, floor: int = 100) -> DataFrame:
    """How many state-years with two or more busy diseases each disease takes part in."""
    companions = F.count("*").over(Window.partitionBy("state", "year"))
    return (_busy_state_years(buckets, floor).withColumn("n", companions)
            .filter(F.col("n") >= 2)
            .groupBy(F.col("disease").alias("disease_a"))
            .agg(F.count("*").alias("co_occurrence_count"))
            .orderBy(F.desc("co_occurrence_count"), "disease_a"))


def q07_bucket(buckets: Buckets, disease: str = "MEASLES") -> DataFrame:
    """States in order of first report with ordinal ranks; ties are ordered by state."""
    first = (_of(buckets, disease).filter(F.col(CASES) > 0).groupBy(F.col(STATE).alias("state_name"))
             .agg(F.min(F.col(YEAR)).alias("first_reported_year")))
    return first_years_ranked(first, ordinal=True).orderBy("spread_rank")


def q08_bucket(buckets: Buckets, span: int = 10) -> DataFrame:
    """Before/after means; diseases without a modern vaccine year are skipped, empty windows are 0."""
    yearly = (buckets.summaries()
              .filter(F.col("disease.vaccine_year") >= 1900)
              .groupBy(F.col(NAME).alias("disease_name"),
                       F.col("disease.vaccine_year").alias("vaccine_intro_year"),
                       F.col(YEAR).alias("year"))
              .agg(F.sum(F.col(CASES)).alias("yearly_total")))
    pre, n_pre = window_total("before", "yearly_total", span)
    post, n_post = window_total("after", "yearly_total", span)
    none = F.lit(0.0)
    means = (yearly.groupBy("disease_name", "vaccine_intro_year")
             .agg(pre.alias("a"), n_pre.alias("n_a"), post.alias("b"), n_post.alias("n_b"))
             .withColumn("pre", F.coalesce(F.col("a") / guards.null_if_zero(F.col("n_a")), none))
             .withColumn("post", F.coalesce(F.col("b") / guards.null_if_zero(F.col("n_b")), none)))
    base = guards.null_if_zero(F.col("pre"))
    change = (F.col("post") - F.col("pre")) / base * 100
    return means.select(
        "disease_name", "vaccine_intro_year",
        rounding.half_even(F.col("pre"), 0).alias("pre_vaccine_avg_annual_cases"),
        rounding.half_even(F.col("post"), 0).alias("post_vaccine_avg_annual_cases"),
        F.coalesce(rounding.half_even(change, 2), none).alias("pct_change"),
    ).orderBy("pct_change", "disease_name")


def q09_bucket(buckets: Buckets, threshold: float = 2.0, k: int = 50) -> DataFrame:
    """State-years more than ``threshold`` population deviations above the mean."""
    totals = (buckets.summaries()
              .groupBy(F.col(NAME).alias("disease_name"), F.col(STATE).alias("state_name"),
                       F.col(YEAR).alias("year"))
              .agg(F.sum(F.col(CASES)).alias("state_total")))
    nation = Window.partitionBy("disease_name", "year")
    total = F.col("state_total")
    mean, std = moments.mean(total, nation), moments.deviation(total, nation, sample=False)
    # The order is by the unrounded score; beyond nine digits it is floating-point noise.
    return (totals.withColumns({"mean": mean, "std": std}).filter(F.col("std") > 0)
            .withColumn("z", (F.col("state_total") - F.col("mean")) / F.col("std"))
            .filter(F.col("z") > threshold)
            .withColumn("score", F.round("z", 9))
            .orderBy(F.desc("score"), "disease_name", "state_name", "year").limit(k)
            .select("disease_name", "state_name", "year", "state_total",
                    rounding.half_even(F.col("mean"), 0).alias("national_mean"),
                    rounding.half_even(F.col("z"), 2).alias("z_score")))


def q10_bucket(buckets: Buckets) -> DataFrame:
    yearly = (buckets.summaries()
              .groupBy(F.col(NAME).alias("disease_name"), F.col(YEAR).alias("year"))
              .agg(F.sum(F.col(CASES)).alias("total_cases")))
    peak = F.max("total_cases").over(Window.partitionBy("disease_name"))
    index = F.col("total_cases") / guards.at_least_one(F.col("peak")) * 100
    return (yearly.withColumn("peak", peak)
            .select("disease_name", "year", "total_cases",
                    rounding.half_even(index, 2).alias("normalized_index"))
            .orderBy("disease_name", "year"))
