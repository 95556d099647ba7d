"""Continuous queries over surveillance events. Each works on a stream and on a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.functions.epiweek import week_start

ALERT_THRESHOLD = 50.0


def validated(events: DataFrame) -> DataFrame:
    """Events with a disease and a non-negative case count; null counts drop too."""
    return events.filter((F.col("cases") >= 0) & F.col("disease").isNotNull())


def with_week_start(events: DataFrame) -> DataFrame:
    """Events with the first day of their week, the event time of weekly totals."""
    return events.withColumn("week_start", week_start(F.col("epi_week")))


def national_totals(events: DataFrame, late_weeks: int | None = None) -> DataFrame:
    """Running totals per disease and week.

    State is kept for every week unless ``late_weeks`` bounds it: then weeks older than
    that many weeks behind the newest one are closed and their late events dropped. In append
    mode a week is then emitted once, when it closes, and leaves the state;
    ``sinks.record_late`` keeps what came too late.
    """
    keys = ["disease", "epi_week"]
    if late_weeks is not None:
        events = with_week_start(events).withWatermark("week_start", f"{late_weeks * 7} days")
        keys = [*keys, "week_start"]
    return events.groupBy(*keys).agg(
        F.sum("cases").alias("national_cases"), F.count("*").alias("states_reporting"),
        F.avg("incidence_rate").alias("avg_national_incidence"))


def alerts(events: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    return events.filter(F.col("incidence_rate") > threshold).withColumn(
        "alert_type", F.lit("HIGH_INCIDENCE"))


def event_rates(events: DataFrame, time: str = "timestamp", length: int = 10, step: int = 1,
                lateness: str | None = None) -> DataFrame:
    """Events per second over a sliding window, one decimal.

    Every event counts unless ``lateness`` bounds the state: then windows that ended longer
    ago than that, seen from the newest event, are closed and their late events dropped.
    """
    window = F.window(time, f"{length} seconds", f"{step} seconds")
    if lateness is not None:
        events = events.withWatermark(time, lateness)
    return (events.groupBy(window)
            .agg(F.count("*").alias("events"))
            .select(F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"), "events",
                    F.round(F.col("events") / F.lit(float(length)), 1).alias("rate")))


def pane_counts(events: DataFrame, time: str = "timestamp", step: int = 1) -> DataFrame:
    """Events per pane of ``step`` seconds: what sliding windows of whole panes are made of."""
    return events.groupBy(F.window(time, f"{step} seconds").alias("pane")).agg(
        F.count("*").alias("n")).select(F.col("pane.start").alias("pane_start"), "n")


def _rates(counted: DataFrame, length: int) -> DataFrame:
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                          "events", F.round(F.col("events") / F.lit(float(length)), 1).alias("rate"))


def rates_of_panes(panes: DataFrame, length: int = 10, step: int = 1) -> DataFrame:
    """``event_rates`` from pane counts: a pane, not an event, is copied to the windows it is in."""
    window = F.window("pane_start", f"{length} seconds", f"{step} seconds")
    return _rates(panes.groupBy(window).agg(F.sum("n").alias("events")), length)


def closed_event_rates(events: DataFrame, lateness: str, time: str = "timestamp", length: int = 10,
                       step: int = 1) -> DataFrame:
    """``event_rates`` of closed windows, for append mode: counts per pane, then sums per window.

    Both aggregations are stateful and bounded by the watermark. Events that come later than
    ``lateness`` behind the newest one are dropped.
    """
    panes = events.withWatermark(time, lateness).groupBy(
        F.window(time, f"{step} seconds").alias("pane")).agg(F.count("*").alias("n"))
    window = F.window("pane", f"{length} seconds", f"{step} seconds")
    return _rates(panes.groupBy(window).agg(F.sum("n").alias("events")), length)
