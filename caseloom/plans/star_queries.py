"""Decision queries 1 to 10 on the star model. All read state-grain rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom.functions import guards, moments, rounding
from caseloom.operators.models import Star


def _mean_rate():
    """Mean of the rates behind place totals, two decimals."""
    mean = F.sum("rates").cast("decimal(26,4)") / F.sum("n").cast("decimal(16,0)")
    return rounding.half_up(mean, 2).alias("avg_incidence")


def _cases():
    return F.sum("cases").alias("total_cases")


def q01_star(star: Star) -> DataFrame:
    """Cases and mean weekly rate by disease and decade."""
    totals = star.rows().groupBy("disease_key", "decade").agg(
        F.sum("case_count").alias("cases"), F.sum("incidence_rate").alias("rates"),
        F.count("incidence_rate").alias("n"))
    return (totals.join(star.diseases, "disease_key").groupBy("disease_name", "decade")
            .agg(_cases(), _mean_rate()).orderBy("disease_name", "decade"))


def q02_star(star: Star, year: int = 1960, disease: str = "MEASLES") -> DataFrame:
    """Cases and mean weekly rate by state in one year."""
    return (star.named_states(star.place_totals(disease=disease, years=(year, year)))
            .groupBy("state_name").agg(_cases(), _mean_rate())
            .orderBy(F.desc("total_cases"), "state_name"))


def q03_star(star: Star, disease: str = "MEASLES", start_year: int = 1950,
             end_year: int = 1970, k: int = 10) -> DataFrame:
    """The k states with most cases in a range of years."""
    return (star.named_states(star.place_totals(disease=disease, years=(start_year, end_year)))
            .groupBy("state_name").agg(_cases())
            .orderBy(F.desc("total_cases"), "state_name").limit(k))


def q04_star(star: Star, disease: str = "MEASLES") -> DataFrame:
    """Mean weekly cases per calendar month."""
    wanted = star.diseases.filter(F.col("disease_name") == disease).select("disease_key")
    weeks = star.rows().join(wanted, "disease_key").groupBy("time_key").agg(
        F.sum("case_count").alias("cases"), F.count("case_count").alias("n"))
    mean = rounding.exact_ratio(F.sum("cases"), F.sum("n"))
    return (weeks.join(star.times, "time_key").groupBy("month", "month_name")
            .agg(rounding.half_up(mean, 2).alias("avg_weekly_cases")).orderBy("month"))


def q05_star(star: Star, disease: str = "MEASLES") -> DataFrame:
    """Change against the previous reported year, per state; the first year has nulls."""
    yearly = (star.named_states(star.place_totals("year", disease=disease))
              .groupBy("state_name", "year").agg(_cases()))
    previous = F.lag("total_cases").over(Window.partitionBy("state_name").orderBy("year"))
    change = rounding.exact_ratio(
        (F.col("total_cases") - F.col("prev_year_cases")) * 100,
        guards.null_if_zero(F.col("prev_year_cases")))
    return (yearly.withColumn("prev_year_cases", previous)
            .withColumn("yoy_pct_change", rounding.half_up(change, 2))
            .orderBy("state_name", "year"))


def _state_years(star: Star) -> DataFrame:
    return (star.named_states(star.place_totals("disease_key", "year"))
            .join(star.diseases.select("disease_key", "disease_name"), "disease_key")
            .groupBy("state_name", "year", "disease_name").agg(_cases()))


def q06_star(star: Star, floor: int = 100, min_pairs: int = 10) -> DataFrame:
    """Disease pairs in the same state and year, with the correlation of their totals.

    A state-year holds at most one row per disease, so the pair join is bounded by the
    disease dimension, not by the data.
    """
    busy = _state_years(star).filter(F.col("total_cases") > floor)
    a = busy.select("state_name", "year", F.col("disease_name").alias("disease_a"),
                    F.col("total_cases").alias("cases_a"))
    b = busy.select("state_name", "year", F.col("disease_name").alias("disease_b"),
                    F.col("total_cases").alias("cases_b"))
    return (a.join(b, ["state_name", "year"]).filter(F.col("disease_a") < F.col("disease_b"))
            .groupBy("disease_a", "disease_b")
            .agg(F.count("*").alias("co_occurrence_count"),
                 rounding.half_up(moments.correlation(F.col("cases_a"), F.col("cases_b")), 3).alias("correlation"))
            .filter(F.col("co_occurrence_count") > min_pairs)
            .orderBy(F.desc_nulls_first("correlation"), "disease_a", "disease_b"))


def first_years_ranked(first_years: DataFrame, ordinal: bool = False) -> DataFrame:
    """Adds ``spread_rank``: RANK by first year, or ordinal numbers with the state as tiebreak.

    The window holds one row per state, which the reference table bounds.
    """
    place = (F.row_number().over(Window.orderBy("first_reported_year", "state_name")) if ordinal
             else F.rank().over(Window.orderBy("first_reported_year")))
    return first_years.select("state_name", "first_reported_year", place.cast("int").alias("spread_rank"))


def q07_star(star: Star, disease: str = "MEASLES") -> DataFrame:
    """States ranked by the first year with cases; ties share a rank."""
    first = (star.named_states(star.place_totals(disease=disease, where=F.col("case_count") > 0))
             .groupBy("state_name").agg(F.min("first_year").alias("first_reported_year")))
    return first_years_ranked(first).orderBy("first_reported_year", "state_name")


def window_total(position: str, total: str, span: int):
    """(sum, count) of yearly totals in the span before or after the introduction year."""
    year, vy = F.col("year"), F.col("vaccine_intro_year")
    inside = (year.between(vy - span, vy - 1) if position == "before"
              else year.between(vy + 1, vy + span))
    return F.sum(F.when(inside, F.col(total))), F.count(F.when(inside, F.col(total)))


def q08_star(star: Star, span: int = 10) -> DataFrame:
    """Mean yearly cases before and after the vaccine, over years that report.

    One pass: both windows are conditional aggregates over the yearly totals. Diseases
    without data in a window stay, with nulls.
    """
    yearly = (star.rows().groupBy("disease_key", "year")
              .agg(F.sum("case_count").alias("yearly_total")))
    known = star.diseases.filter(F.col("vaccine_intro_year").isNotNull())
    pre, n_pre = window_total("before", "yearly_total", span)
    post, n_post = window_total("after", "yearly_total", span)
    windows = (known.join(yearly, "disease_key", "left")
               .groupBy("disease_name", "vaccine_intro_year")
               .agg(pre.alias("pre"), n_pre.alias("n_pre"),
                    post.alias("post"), n_post.alias("n_post")))
    before = F.col("pre") * F.col("n_post")
    change = rounding.exact_ratio(
        (F.col("post") * F.col("n_pre") - before) * 100, guards.null_if_zero(before))
    return windows.select(
        "disease_name", "vaccine_intro_year",
        (F.col("pre") / guards.null_if_zero(F.col("n_pre"))).alias("pre_vaccine_avg_annual_cases"),
        (F.col("post") / guards.null_if_zero(F.col("n_post"))).alias("post_vaccine_avg_annual_cases"),
        rounding.half_up(change, 2).alias("pct_change"),
    ).orderBy(F.asc_nulls_last("pct_change"), "disease_name")


def q09_star(star: Star, threshold: float = 2.0, k: int = 50) -> DataFrame:
    """State-years more than ``threshold`` sample deviations above the national mean."""
    totals = _state_years(star).withColumnRenamed("total_cases", "state_total")
    nation = Window.partitionBy("disease_name", "year")
    total = F.col("state_total")
    mean, std = moments.mean(total, nation), moments.deviation(total, nation)
    return (totals.withColumns({"mean": mean, "std": std}).filter(F.col("std") > 0)
            .withColumn("z", (F.col("state_total") - F.col("mean")) / F.col("std"))
            .filter(F.col("z") > threshold)
            .select("disease_name", "state_name", "year", "state_total",
                    rounding.half_up(F.col("mean"), 0).alias("national_mean"),
                    rounding.half_up(F.col("z"), 2).alias("z_score"))
            .orderBy(F.desc("z_score"), "disease_name", "state_name", "year").limit(k))


def q10_star(star: Star) -> DataFrame:
    """Yearly cases as a percentage of the disease's highest year."""
    totals = star.rows().groupBy("disease_key", "year").agg(F.sum("case_count").alias("cases"))
    yearly = (totals.join(star.diseases.select("disease_key", "disease_name"), "disease_key")
              .groupBy("disease_name", "year").agg(_cases()))
    peak = F.max("total_cases").over(Window.partitionBy("disease_name"))
    index = rounding.exact_ratio(F.col("total_cases") * 100, guards.null_if_zero(F.col("peak")))
    return (yearly.withColumn("peak", peak)
            .select("disease_name", "year", "total_cases",
                    rounding.half_up(index, 2).alias("normalized_index"))
            .orderBy("disease_name", "year"))
