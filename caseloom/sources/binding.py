"""The driver's TPC-H-like tables read as surveillance data.

Line items become weekly counts: the part type is the disease, the supplier's nation
the state, and the ship date the week. One disease (PROMO) reports at city grain, with
the supplier as the city. No side is force-broadcast: part and supplier grow with the
data, so Catalyst and AQE decide from measured sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions import rounding

# Introduction year per disease of the binding.
INTRODUCTION_YEARS = {
    "STANDARD": 1998, "SMALL": 1999, "MEDIUM": 1997, "LARGE": 1995, "ECONOMY": 1796, "PROMO": 1998,
}
CITY_DISEASE = "PROMO"
# Neighbours of state i are i + offset, modulo the number of states.
BORDER_OFFSETS = [1, 24, 5, 20]
STATE_COUNT = 25
# Scorer parameters per disease of the binding: base rate, amplitude, peak week, decay.
EXPECTATION = {
    "ECONOMY": (2.5, 0.25, 6, 0.02), "LARGE": (3.25, 0.5, 17, 0.35), "MEDIUM": (6.0, 0.1, 22, 0.07),
    "PROMO": (0.3, 0.55, 49, 0.4), "SMALL": (9.5, 0.45, 36, 0.18), "STANDARD": (7.0, 0.15, 3, 0.22),
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epi_week(ts):
    week = F.floor((F.dayofyear(ts) - 1) / 7).cast("int") + 1
    return F.year(ts) * 100 + F.least(F.lit(53), week)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly observations, one row per (disease, state, place, week).

    What moves with every item is narrow: week and cents are made before the joins, and the
    grain and the state as a place are told from the group's disease and state after it is
    added up.
    """
    nations = _table(spark, sf_dir, "nation").join(
        _table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    places = _table(spark, sf_dir, "supplier").join(
        nations, F.col("n_nationkey") == F.col("s_nationkey")).select("s_suppkey", "s_name", "n_name")
    kinds = _table(spark, sf_dir, "part").select("p_partkey", "p_type")
    items = _table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", epi_week(F.col("l_shipdate")).alias("epi_week"),
        F.col("l_quantity").cast("int").alias("quantity"),
        rounding.whole_half_up(F.col("l_extendedprice") * 100).alias("cents"))
    city = F.col("disease") == CITY_DISEASE
    rows = (items.join(kinds, F.col("p_partkey") == F.col("l_partkey"))
            .join(places, F.col("s_suppkey") == F.col("l_suppkey"))
            .select(F.col("p_type").alias("disease"), F.col("n_name").alias("state"), "epi_week",
                    F.when(F.col("p_type") == CITY_DISEASE, F.col("s_name")).alias("city_name"),
                    "quantity", "cents"))
    totals = rows.groupBy("disease", "state", "city_name", "epi_week").agg(
        F.sum("quantity").alias("cases"),
        (F.sum("cents").cast("double") / (F.lit(1e5) * F.count("*"))).alias("incidence_per_100000"))
    return totals.select(
        "disease", "state", F.when(city, F.col("city_name")).otherwise(F.col("state")).alias("loc"),
        F.when(city, "CITY").otherwise("STATE").alias("loc_type"), "epi_week", "cases",
        "incidence_per_100000")


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (_table(spark, sf_dir, "nation")
            .join(_table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
            .select(
                F.col("n_name").alias("state_code"), F.col("n_name").alias("state_name"),
                F.col("r_name").alias("census_region"),
                F.concat(F.col("r_name"), F.lit(" "), (F.col("n_nationkey") % 2).cast("string"))
                .alias("census_division"),
                (F.col("n_nationkey") + 0.25).cast("double").alias("latitude"),
                (-F.col("n_nationkey") - 0.5).cast("double").alias("longitude")))


def diseases(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = F.create_map(*[F.lit(v) for pair in INTRODUCTION_YEARS.items() for v in pair])
    name = F.col("p_type")
    return (_table(spark, sf_dir, "part").select("p_type").distinct()
            .filter(name.isin(list(INTRODUCTION_YEARS)))
            .select(
                name.alias("disease_name"),
                F.when(name.isin("STANDARD", "SMALL", "MEDIUM"), "Viral").otherwise("Bacterial")
                .alias("disease_category"),
                F.when(name == "ECONOMY", "Contact").otherwise("Airborne").alias("transmission_type"),
                F.when(name == "ECONOMY", "False").otherwise("TRUE").alias("is_vaccine_preventable"),
                pairs[name].alias("vaccine_intro_year")))


def populations(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = (_table(spark, sf_dir, "customer").groupBy("c_nationkey")
              .agg((F.count("*") * 1000).alias("base")))
    per_state = counts.join(
        _table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    steps = F.explode(F.array(
        F.struct(F.lit(1990).alias("decade"), F.lit(10).alias("tenths")),
        F.struct(F.lit(2000).alias("decade"), F.lit(11).alias("tenths")))).alias("step")
    return per_state.select(F.col("n_name").alias("state_code"), "base", steps).select(
        "state_code", F.col("step.decade").alias("decade"),
        (F.col("base") / 10 * F.col("step.tenths")).cast("int").alias("population"),
        F.lit("customers").alias("source"))


def border_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State with its neighbours as one space-separated text."""
    names = [F.concat(F.lit("NATION_"), ((F.col("n_nationkey") + k) % STATE_COUNT).cast("string"))
             for k in BORDER_OFFSETS]
    return _table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("state_code"), F.concat_ws(" ", *names).alias("borders"))


def expectation_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = []
    for position, field in enumerate(["base_rate", "seasonal_amp", "peak_week", "decay"]):
        pairs = [F.lit(v) for name, row in EXPECTATION.items() for v in (name, row[position])]
        columns.append(F.create_map(*pairs)[F.col("disease_name")].alias(field))
    return diseases(spark, sf_dir).select(
        F.col("disease_name").alias("disease"), *columns,
        F.col("vaccine_intro_year").alias("vaccine_year"))


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surveillance events with their event time, one per row of ``events``."""
    user = (F.col("user_id") % STATE_COUNT).cast("string")
    state = F.concat(F.lit("NATION_"), user)
    return _table(spark, sf_dir, "events").select(
        epi_week(F.col("ts")).alias("epi_week"), state.alias("state"), state.alias("loc"),
        F.lit("STATE").alias("loc_type"), F.col("event_type").alias("disease"),
        F.get_json_object("props", "$.k").cast("int").alias("cases"),
        F.col("value").alias("incidence_rate"),
        F.col("ts").cast("timestamp").alias("timestamp"), "event_id")
