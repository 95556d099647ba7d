"""Star model: three dimensions and the weekly fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom import schemas
from caseloom.functions.epiweek import decade_of, with_time_fields, year_of
from caseloom.functions.text import true_text


def dense_keys(df: DataFrame, key: str, group: list[str], order: list[str], kind: str = "int") -> DataFrame:
    """Numbers rows 1..n in the order (group, order) without one global sort.

    Rows are numbered inside their group and shifted by the size of all earlier groups;
    only the per-group counts pass through one ordered window.
    """
    sizes = df.groupBy(*group).agg(F.count("*").alias("_size"))
    before = Window.orderBy(*[F.col(c).asc_nulls_first() for c in group]).rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *[F.col(c).alias(f"_g_{c}") for c in group],
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    same = None
    for column in group:
        term = F.col(column).eqNullSafe(F.col(f"_g_{column}"))
        same = term if same is None else same & term
    inside = Window.partitionBy(*group).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return (df.withColumn("_place", F.row_number().over(inside)).join(offsets, same)
            .withColumn(key, (F.col("_place") + F.col("_offset")).cast(kind))
            .drop("_place", "_offset", *[f"_g_{c}" for c in group]))


def conform(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def build_dim_time(obs: DataFrame) -> DataFrame:
    """One row per reported week, keyed from 1 in week order."""
    weeks = with_time_fields(obs.select("epi_week").distinct())
    return conform(dense_keys(weeks, "time_key", ["year"], ["epi_week"]), schemas.DIM_TIME)


def build_dim_location(obs: DataFrame, regions: DataFrame) -> DataFrame:
    """Reported states, then reported cities; unknown states keep empty attributes.

    Cities are numbered per state and hash group, so a state with most of all cities is
    still numbered by many tasks.
    """
    states = obs.filter(F.col("loc_type") == "STATE").select(
        F.lit(None).cast("string").alias("city_name"), F.col("state").alias("state_code"),
        F.lit("STATE").alias("loc_type"), F.lit(0).alias("_grain"))
    cities = obs.filter(F.col("loc_type") == "CITY").select(
        F.col("loc").alias("city_name"), F.col("state").alias("state_code"),
        F.lit("CITY").alias("loc_type"), F.lit(1).alias("_grain"))
    places = states.unionByName(cities).distinct().withColumn(
        "_spread", F.substring(F.md5("city_name"), 1, 2))
    keyed = dense_keys(places, "location_key", ["_grain", "state_code", "_spread"], ["city_name"])
    return conform(keyed.join(regions, "state_code", "left"), schemas.DIM_LOCATION)


def build_dim_disease(diseases: DataFrame) -> DataFrame:
    """Reference diseases keyed from 1 in name order."""
    named = diseases.withColumn("is_vaccine_preventable", true_text(F.col("is_vaccine_preventable")))
    initial = named.withColumn("_initial", F.substring("disease_name", 1, 1))
    return conform(dense_keys(initial, "disease_key", ["_initial"], ["disease_name"]),
                   schemas.DIM_DISEASE)


def _located(obs: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Adds the location key: state rows by state, all others by (state, city).

    The two grains are joined apart, so the state rows (the hot keys) only ever meet the
    small state dimension and the city join shuffles city rows alone.
    """
    key = F.col("location_key")
    states = dim_location.filter(F.col("loc_type") == "STATE").select(
        F.col("state_code").alias("state"), key)
    cities = dim_location.filter(F.col("loc_type") == "CITY").select(
        F.col("state_code").alias("state"), F.col("city_name").alias("loc"), key)
    at_state = obs.filter(F.col("loc_type") == "STATE").join(states, "state")
    at_city = obs.filter(F.col("loc_type") != "STATE").join(cities, ["state", "loc"])
    return at_state.withColumn("loc_type", F.lit("STATE")).unionByName(
        at_city.withColumn("loc_type", F.lit("CITY")))


def build_fact(obs: DataFrame, dim_time: DataFrame, dim_location: DataFrame,
               dim_disease: DataFrame, populations: DataFrame) -> DataFrame:
    """One row per observation whose week, place and disease are all known.

    Population is looked up by (state, decade) and stays null on city rows. ``loc_type``
    and ``decade`` are the partition columns of the stored table. The key numbers the rows of
    a week and disease, shifted by the size of all earlier groups, so it is unique also where
    observations repeat; only rows equal in every column could swap keys if a task is repeated.
    """
    weeks = dim_time.select("epi_week", "time_key")
    kinds = dim_disease.select(F.col("disease_name").alias("disease"), "disease_key")
    people = populations.select(F.col("state_code").alias("state"), "decade", "population")
    rows = (_located(obs, dim_location).join(weeks, "epi_week").join(kinds, "disease")
            .withColumn("decade", decade_of(year_of(F.col("epi_week"))))
            .join(people, ["state", "decade"], "left"))
    keyed = dense_keys(rows, "incidence_key", ["time_key", "disease_key"],
                       ["location_key", "cases", "incidence_per_100000"], "long")
    return conform(keyed.select(
        "incidence_key", "time_key", "location_key", "disease_key", F.col("cases").alias("case_count"),
        F.col("incidence_per_100000").cast(schemas.RATE).alias("incidence_rate"),
        F.when(F.col("loc_type") == "STATE", F.col("population")).alias("population"),
        year_of(F.col("epi_week")).alias("year"), "loc_type", "decade"), schemas.FACT)
