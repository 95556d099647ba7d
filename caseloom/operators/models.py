"""Handles on the three stored models."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.operators.bucket import documents


@dataclass(frozen=True)
class Star:
    """Fact and dimensions. Small integers are widened here, storage keeps them short."""

    fact: DataFrame
    dim_time: DataFrame
    dim_location: DataFrame
    dim_disease: DataFrame

    @cached_property
    def times(self) -> DataFrame:
        shorts = ["week_number", "month", "quarter", "year", "decade", "century"]
        wide = self.dim_time.withColumns({c: F.col(c).cast("int") for c in shorts})
        # The fact carries year and decade itself.
        return wide.withColumnRenamed("decade", "time_decade").drop("year")

    @cached_property
    def diseases(self) -> DataFrame:
        return self.dim_disease.withColumn(
            "vaccine_intro_year", F.col("vaccine_intro_year").cast("int"))

    def place_totals(self, *keys: str, grain: str | None = "STATE", disease: str | None = None,
                     years: tuple[int, int] | None = None, where: Column | None = None) -> DataFrame:
        """Fact totals per place and the given fact columns: cases, rates, their number, first year.

        Names are joined to these few rows, not to the fact; only a chosen disease is joined
        before, to prune partitions.
        """
        rows = self.rows(grain=grain, years=years, where=where)
        if disease is not None:
            rows = rows.join(self.diseases.filter(F.col("disease_name") == disease)
                             .select("disease_key"), "disease_key")
        return rows.groupBy("location_key", *keys).agg(
            F.sum("case_count").alias("cases"), F.sum("incidence_rate").alias("rates"),
            F.count("incidence_rate").alias("n"), F.min("year").alias("first_year"))

    def named_states(self, totals: DataFrame) -> DataFrame:
        """Place totals with the state's name (null for states without reference)."""
        names = self.dim_location.filter(F.col("loc_type") == "STATE").select("location_key", "state_name")
        return totals.join(names, "location_key")

    def rows(self, *dims: str, grain: str | None = "STATE", where: Column | None = None,
             years: tuple[int, int] | None = None) -> DataFrame:
        """The fact joined with the named dimensions (``time``, ``disease``, ``location``).

        ``grain`` and ``years`` prune fact partitions at planning time, and the year row
        groups as well. Foreign keys are
        checked at load, so a dimension that is not used need not be joined.
        """
        fact = self.fact
        if grain:
            fact = fact.filter(F.col("loc_type") == grain)
        if years:
            first, last = years
            fact = fact.filter(F.col("decade").between(first - first % 10, last - last % 10)
                               & F.col("year").between(first, last))
        rows = fact
        if "disease" in dims:
            rows = rows.join(self.diseases, "disease_key")
        if "time" in dims:
            rows = rows.join(self.times, "time_key")
        if "location" in dims:
            places = self.dim_location
            if grain:
                places = places.filter(F.col("loc_type") == grain)
            rows = rows.join(places.drop("loc_type"), "location_key")
        return rows.filter(where) if where is not None else rows


@dataclass(frozen=True)
class Buckets:
    buckets: DataFrame
    rows: DataFrame

    def summaries(self) -> DataFrame:
        """One row per bucket, with its summary."""
        return self.buckets

    def weeks(self) -> DataFrame:
        """One row per weekly observation."""
        return self.rows

    @property
    def documents(self) -> DataFrame:
        """The nested documents; their arrays are made on demand."""
        return documents(self.buckets, self.rows)


@dataclass(frozen=True)
class Graph:
    nodes: dict[str, DataFrame]
    borders: DataFrame
    regions: DataFrame

    @property
    def aggregates(self) -> DataFrame:
        return self.nodes["MonthlyAggregate"]
