"""Graph model: node sets, edge sets and the monthly aggregates per state.

Hierarchies (week to decade, city to region) are functions of the child's own columns,
so edges of that kind are projections of a node table; only borders is a stored relation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom import schemas
from caseloom.functions import rounding
from caseloom.functions.epiweek import (
    decade_of, month_name_of, quarter_of, with_year_month)
from caseloom.functions.text import neighbour_list, true_text
from caseloom.operators.star import conform

COUNTRY = "USA"


def borders(border_lists: DataFrame) -> DataFrame:
    """Directed neighbour edges; a repeated pair is one edge."""
    pairs = border_lists.select(
        F.col("state_code").alias("src"), F.explode(neighbour_list(F.col("borders"))).alias("dst"))
    return pairs.filter(F.col("dst") != "").dropDuplicates(["src", "dst"])


def border_edges(border_lists: DataFrame, regions: DataFrame) -> DataFrame:
    """Borders between states that exist as nodes."""
    codes = regions.select("state_code").distinct()
    return (borders(border_lists)
            .join(codes.withColumnRenamed("state_code", "src"), "src", "left_semi")
            .join(codes.withColumnRenamed("state_code", "dst"), "dst", "left_semi")
            .select("src", "dst"))


def _quarter_id(year: Column, quarter: Column) -> Column:
    return year * 10 + quarter


def _month_id(year: Column, month: Column) -> Column:
    return year * 100 + month


def _city_id(state: Column, city: Column) -> Column:
    return F.concat_ws("|", state, city)


def calendar_nodes(dim_time: DataFrame) -> dict[str, DataFrame]:
    """Decade, year, quarter, month and week nodes of the reported weeks.

    They are read off the time dimension; every year has all four quarters.
    """
    weeks = dim_time.withColumns({c: F.col(c).cast("int") for c in ("year", "month", "week_number")})
    years = weeks.select("year").distinct()
    quarters = F.explode(F.array(*[F.lit(q) for q in range(1, 5)])).alias("quarter")
    return {
        "Decade": years.select(decade_of(F.col("year")).alias("decade")).distinct(),
        "Year": years,
        "Quarter": years.select("year", quarters),
        "Month": weeks.select("year", "month", "month_name").distinct(),
        "Week": weeks.select("epi_week", "week_number", "year", "month"),
    }


def place_nodes(dim_location: DataFrame, regions: DataFrame) -> dict[str, DataFrame]:
    """Region, country, state and city nodes; cities are those of the location dimension."""
    region = regions.select(F.col("census_region").alias("name")).distinct()
    return {
        "Region": region,
        "Country": region.select(F.lit(COUNTRY).alias("name")).distinct(),
        "State": regions.select(
            F.col("state_code").alias("code"), F.col("state_name").alias("name"),
            F.col("census_division").alias("division"), "latitude", "longitude"),
        "City": dim_location.filter(F.col("loc_type") == "CITY").select(
            "state_code", F.col("city_name").alias("name")),
    }


def disease_nodes(diseases: DataFrame) -> DataFrame:
    return diseases.select(
        F.col("disease_name").alias("name"), F.col("disease_category").alias("category"),
        F.col("transmission_type").alias("transmission"),
        true_text(F.col("is_vaccine_preventable")).alias("vaccine_preventable"),
        F.col("vaccine_intro_year").alias("vaccine_year"))


def observation_nodes(obs: DataFrame, regions: DataFrame, diseases: DataFrame) -> DataFrame:
    """Observations tied to a known disease and to a state or city node.

    A row at state grain needs a known state; any other row needs a city node of that
    (state, name). The ids are fixed by storing this table, not by recomputing it.
    """
    known = obs.join(diseases.select(F.col("disease_name").alias("disease")).distinct(),
                     "disease", "left_semi")
    states = regions.select(F.col("state_code").alias("state")).distinct()
    cities = obs.filter(F.col("loc_type") == "CITY").select("state", "loc").distinct()
    at_state = (known.filter(F.col("loc_type") == "STATE").join(states, "state", "left_semi")
                .select("*", F.lit("STATE").alias("grain"),
                        F.lit(None).cast("string").alias("city_name")))
    is_city = F.col("loc_type") == "CITY"
    named = known.filter(is_city).unionByName(
        known.filter((F.col("loc_type") != "STATE") & ~is_city)
        .join(cities, ["state", "loc"], "left_semi"))
    at_city = named.select("*", F.lit("CITY").alias("grain"), F.col("loc").alias("city_name"))
    rows = with_year_month(at_state.unionByName(at_city))
    return conform(rows.select(
        F.monotonically_increasing_id().alias("observation_id"),
        F.col("cases").alias("case_count"),
        rounding.half_even(F.col("incidence_per_100000"), 4).alias("incidence_rate"),
        "grain", "disease", F.col("state").alias("state_code"), "city_name",
        "epi_week", "year", "month"), schemas.OBSERVATION_NODES)


def monthly_aggregates(observations: DataFrame, regions: DataFrame) -> DataFrame:
    """Per disease, state and month; city rows count for the state their city lies in."""
    grouped = observations.groupBy("disease", "state_code", "year", "month").agg(
        F.sum("case_count").alias("total_cases"),
        F.sum(rounding.rate_units(F.col("incidence_rate"))).alias("units"),
        F.count("*").alias("observation_count"))
    rows = grouped.join(regions.select("state_code", "state_name"), "state_code")
    return conform(rows.select(
        "disease", "state_code", "state_name", "year", "month",
        month_name_of(F.col("month")).alias("month_name"),
        quarter_of(F.col("month")).alias("quarter"), "total_cases",
        rounding.mean_of_units(F.col("units"), F.col("observation_count")).alias("avg_incidence"),
        "observation_count", decade_of(F.col("year")).alias("decade")), schemas.MONTHLY_AGGREGATES)


def aggregate_over_paths(observations: DataFrame, states: DataFrame, cities: DataFrame) -> DataFrame:
    """The same aggregate along explicit paths: two optional routes to a state, coalesced."""
    direct = states.select(F.col("code").alias("state_code"), F.col("code").alias("s1"))
    through = cities.join(direct, "state_code").select(
        "state_code", F.col("name").alias("city_name"), F.col("s1").alias("s2"))
    is_state = F.col("grain") == "STATE"
    routed = (observations
              .withColumn("own", F.when(is_state, F.col("state_code")))
              .withColumn("of_city", F.when(~is_state, F.col("state_code")))
              .join(direct.select(F.col("state_code").alias("own"), "s1"), "own", "left")
              .join(through.select(F.col("state_code").alias("of_city"), "city_name", "s2"),
                    ["of_city", "city_name"], "left")
              .withColumn("state", F.coalesce("s1", "s2")).filter(F.col("state").isNotNull()))
    return routed.groupBy("disease", "state", "year", "month").agg(
        F.sum("case_count").alias("total_cases"),
        F.sum(rounding.rate_units(F.col("incidence_rate"))).alias("units"),
        F.count("*").alias("observation_count"))


def edges(kind: str, nodes: dict[str, DataFrame], regions: DataFrame,
          border_table: DataFrame) -> DataFrame:
    """One edge set as (src, dst) of node keys; pairs without both end nodes are absent."""
    col = F.col

    def project(label: str, src: Column, dst: Column) -> DataFrame:
        return nodes[label].select(src.cast("string").alias("src"), dst.cast("string").alias("dst"))

    month = _month_id(col("year"), col("month"))
    builders = {
        "IN_COUNTRY": lambda: project("Region", col("name"), F.lit(COUNTRY)),
        "IN_REGION": lambda: regions.select(
            col("state_code").alias("src"), col("census_region").alias("dst")),
        "LOCATED_IN_STATE": lambda: project(
            "City", _city_id(col("state_code"), col("name")), col("state_code")).join(
                nodes["State"].select(col("code").alias("dst")), "dst", "left_semi")
        .select("src", "dst"),
        "BORDERS": lambda: border_table.select("src", "dst"),
        "IN_DECADE": lambda: project("Year", col("year"), decade_of(col("year"))),
        "IN_YEAR": lambda: project("Quarter", _quarter_id(col("year"), col("quarter")), col("year")),
        "IN_QUARTER": lambda: project(
            "Month", month, _quarter_id(col("year"), quarter_of(col("month")))),
        "IN_MONTH": lambda: project("Week", col("epi_week"), month),
        "AFFECTS": lambda: project("Observation", col("observation_id"), col("disease")),
        "OBSERVED_IN": lambda: _of_grain(nodes, "STATE").select(
            col("observation_id").cast("string").alias("src"), col("state_code").alias("dst")),
        "OBSERVED_IN_CITY": lambda: _of_grain(nodes, "CITY").select(
            col("observation_id").cast("string").alias("src"),
            _city_id(col("state_code"), col("city_name")).alias("dst")),
        "OBSERVED_AT": lambda: project("Observation", col("observation_id"), col("epi_week")),
        "SUMMARIZES_DISEASE": lambda: project("MonthlyAggregate", aggregate_id(), col("disease")),
        "SUMMARIZES_STATE": lambda: project("MonthlyAggregate", aggregate_id(), col("state_code")),
        "SUMMARIZES_MONTH": lambda: project("MonthlyAggregate", aggregate_id(), month),
    }
    return builders[kind]()


EDGE_KINDS = [
    "IN_COUNTRY", "IN_REGION", "LOCATED_IN_STATE", "BORDERS", "IN_DECADE", "IN_YEAR", "IN_QUARTER",
    "IN_MONTH", "AFFECTS", "OBSERVED_IN", "OBSERVED_IN_CITY", "OBSERVED_AT", "SUMMARIZES_DISEASE",
    "SUMMARIZES_STATE", "SUMMARIZES_MONTH",
]
NODE_LABELS = [
    "Disease", "Region", "Country", "State", "City", "Decade", "Year", "Quarter", "Month", "Week",
    "Observation", "MonthlyAggregate",
]


def aggregate_id() -> Column:
    month = _month_id(F.col("year"), F.col("month")).cast("string")
    return F.concat_ws("|", F.col("disease"), F.col("state_code"), month)


def _of_grain(nodes: dict[str, DataFrame], grain: str) -> DataFrame:
    return nodes["Observation"].filter(F.col("grain") == grain)
