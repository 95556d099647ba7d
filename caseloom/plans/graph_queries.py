"""Decision queries 1 to 13 on the graph model.

Queries 1 to 10, 12 and 13 read the monthly aggregates, whose quarter, year and decade
are columns; query 11 also follows the border edges. City rows are included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom.functions import guards, moments, nested, rounding
from caseloom.functions.epiweek import month_index
from caseloom.operators.models import Graph
from caseloom.plans.star_queries import window_total


def _of(graph: Graph, disease: str, first: int | None = None, last: int | None = None) -> DataFrame:
    rows = graph.aggregates.filter(F.col("disease") == disease)
    if first is not None:
        rows = rows.filter(F.col("decade").between(first - first % 10, last - last % 10)
                           & F.col("year").between(first, last))
    return rows


def _mean_rate():
    return rounding.half_up(F.avg("avg_incidence"), 2).alias("avg_incidence")


def q01_graph(graph: Graph) -> DataFrame:
    """Cases by disease and decade; the rate is the mean of unrounded monthly means."""
    return (graph.aggregates.groupBy(F.col("disease").alias("disease_name"), "decade")
            .agg(F.sum("total_cases").alias("total_cases"), _mean_rate())
            .orderBy("disease_name", "decade"))


def q02_graph(graph: Graph, year: int = 1960, disease: str = "MEASLES") -> DataFrame:
    return (_of(graph, disease, year, year).groupBy("state_name")
            .agg(F.sum("total_cases").alias("total_cases"), _mean_rate())
            .orderBy(F.desc("total_cases"), "state_name"))


def q03_graph(graph: Graph, disease: str = "MEASLES", start_year: int = 1950,
              end_year: int = 1970, k: int = 10) -> DataFrame:
    return (_of(graph, disease, start_year, end_year).groupBy("state_name")
            .agg(F.sum("total_cases").alias("total_cases"))
            .orderBy(F.desc("total_cases"), "state_name").limit(k))


def q04_graph(graph: Graph, disease: str = "MEASLES") -> DataFrame:
    """Mean over months of total div count: an integer division."""
    rows = _of(graph, disease).withColumn("weeks", guards.one_if_zero(F.col("observation_count")))
    per_week = F.expr("total_cases div weeks")
    return (rows.groupBy("month", "month_name")
            .agg(rounding.half_up(F.avg(per_week), 2).alias("avg_weekly_cases"))
            .orderBy("month"))


def q05_graph(graph: Graph, disease: str = "MEASLES") -> DataFrame:
    """Change against the previous reported year; a state's first year has no row."""
    yearly = (_of(graph, disease).groupBy("state_name", "year")
              .agg(F.sum("total_cases").alias("total_cases")))
    previous = F.lag("total_cases").over(Window.partitionBy("state_name").orderBy("year"))
    prev = F.col("prev_year_cases")
    change = (F.col("total_cases") - prev).cast("double") / guards.one_if_zero(prev) * 100
    return (yearly.withColumn("prev_year_cases", previous).filter(prev.isNotNull())
            .withColumn("yoy_pct_change", rounding.half_up(change, 2))
            .orderBy("state_name", "year"))


def q06_graph(graph: Graph, floor: int = 100, k: int = 20) -> DataFrame:
    """The k most frequent disease pairs, without correlation.

    The list of a state-year has at most one entry per disease node. Pairs are expanded
    from it in place and counted map-side, so no pair row is shuffled.
    """
    busy = (graph.aggregates.groupBy("state_code", "year", "disease")
            .agg(F.sum("total_cases").alias("total")).filter(F.col("total") > floor))
    lists = (busy.groupBy("state_code", "year").agg(F.collect_list("disease").alias("diseases"))
             .filter(nested.has_at_least(F.col("diseases"), 2)))
    pairs = (lists.select("diseases", F.explode("diseases").alias("disease_a"))
             .select("disease_a", F.explode("diseases").alias("disease_b"))
             .filter(F.col("disease_a") < F.col("disease_b")))
    return (pairs.groupBy("disease_a", "disease_b")
            .agg(F.count("*").alias("co_occurrence_count"))
            .orderBy(F.desc("co_occurrence_count"), "disease_a", "disease_b").limit(k))


def q07_graph(graph: Graph, disease: str = "MEASLES") -> DataFrame:
    return (_of(graph, disease).filter(F.col("total_cases") > 0).groupBy("state_name")
            .agg(F.min("year").alias("first_reported_year"))
            .orderBy("first_reported_year", "state_name"))


def q08_graph(graph: Graph, span: int = 10) -> DataFrame:
    """Before/after means from the disease nodes; empty windows stay null."""
    modern = graph.nodes["Disease"].filter(F.col("vaccine_year") >= 1900).select(
        F.col("name").alias("disease"), F.col("vaccine_year").alias("vaccine_intro_year"))
    yearly = (graph.aggregates.groupBy("disease", "year")
              .agg(F.sum("total_cases").alias("yearly_total")))
    pre, n_pre = window_total("before", "yearly_total", span)
    post, n_post = window_total("after", "yearly_total", span)
    means = (modern.join(yearly, "disease", "left")
             .groupBy(F.col("disease").alias("disease_name"), "vaccine_intro_year")
             .agg((pre / guards.null_if_zero(n_pre)).alias("pre"),
                  (post / guards.null_if_zero(n_post)).alias("post")))
    change = (F.col("post") - F.col("pre")) / guards.one_if_zero(F.col("pre")) * 100
    return means.select(
        "disease_name", "vaccine_intro_year",
        rounding.half_up(F.col("pre"), 0).alias("pre_vaccine_avg_annual_cases"),
        rounding.half_up(F.col("post"), 0).alias("post_vaccine_avg_annual_cases"),
        rounding.half_up(change, 2).alias("pct_change"),
    ).orderBy(F.asc_nulls_last("pct_change"), "disease_name")


def q09_graph(graph: Graph, threshold: float = 2.0, k: int = 50) -> DataFrame:
    totals = (graph.aggregates
              .groupBy(F.col("disease").alias("disease_name"), "state_name", "year")
              .agg(F.sum("total_cases").alias("state_total")))
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


def q10_graph(graph: Graph) -> DataFrame:
    yearly = (graph.aggregates.groupBy(F.col("disease").alias("disease_name"), "year")
              .agg(F.sum("total_cases").alias("total_cases")))
    peak = F.max("total_cases").over(Window.partitionBy("disease_name"))
    index = F.col("total_cases").cast("double") / guards.one_if_zero(F.col("peak")) * 100
    return (yearly.withColumn("peak", peak)
            .select("disease_name", "year", "total_cases",
                    rounding.half_up(index, 2).alias("normalized_index"))
            .orderBy("disease_name", "year"))


def q11_graph(graph: Graph, disease: str = "MEASLES", threshold: int = 50, max_lag: int = 6,
              k: int | None = 50) -> DataFrame:
    """Busy months of a state followed by a busy month of a neighbour 1..max_lag months on.

    The lag range becomes rows: each origin month is repeated once per lag and neighbour
    and then matched by equality on (neighbour, month). ``k=None`` returns every pair.
    """
    busy = _of(graph, disease).filter(F.col("total_cases") > threshold).select(
        "state_code", "state_name", "year", "month",
        month_index(F.col("year"), F.col("month")).alias("index"))
    origins = busy.select(
        F.col("state_code").alias("src"), F.col("state_name").alias("origin"),
        F.col("year").alias("origin_year"), F.col("month").alias("origin_month"), "index")
    targets = busy.select(
        F.col("state_code").alias("dst"), F.col("state_name").alias("destination"),
        F.col("year").alias("dest_year"), F.col("month").alias("dest_month"), "index")
    lags = F.explode(F.sequence(F.lit(1), F.lit(max_lag))).alias("lag_months")
    reached = (origins.join(graph.borders, "src").select("*", lags)
               .withColumn("index", F.col("index") + F.col("lag_months")))
    pairs = reached.join(targets, ["dst", "index"]).select(
        "origin", "destination", "origin_year", "origin_month", "dest_year", "dest_month",
        "lag_months")
    if k is None:
        return pairs
    return pairs.orderBy("lag_months", "origin", "destination", "origin_year", "origin_month").limit(k)


def q12_graph(graph: Graph) -> DataFrame:
    """Per state, the share of each disease as an array of {disease, pct}."""
    totals = (graph.aggregates.groupBy("state_name", "state_code", "disease")
              .agg(F.sum("total_cases").alias("cases")))
    pattern = F.array_sort(F.collect_list(F.struct("disease", "cases"))).alias("pattern")
    return (totals.groupBy("state_name", "state_code").agg(pattern)
            .select(F.col("state_name").alias("state"), F.col("state_code").alias("code"),
                    nested.share_profile(F.col("pattern"), "disease", "cases", 1).alias("profile"))
            .orderBy("state"))


def q13_graph(graph: Graph, floor: int = 100, denominator: int = 50 * 81) -> DataFrame:
    """State-years in which a disease had a busy month, and their share of the denominator."""
    presence = F.count_distinct("state_code", "year")
    share = F.col("state_year_presence").cast("double") / denominator * 100
    return (graph.aggregates.filter(F.col("total_cases") > floor)
            .groupBy(F.col("disease").alias("disease_name"))
            .agg(presence.alias("state_year_presence"))
            .withColumn("coverage_pct", rounding.half_up(share, 2))
            .orderBy(F.desc("state_year_presence"), "disease_name"))


def lag_histogram(pairs: DataFrame) -> DataFrame:
    """Number of spread pairs per lag."""
    return pairs.groupBy("lag_months").agg(F.count("*").alias("pair_count")).orderBy("lag_months")
