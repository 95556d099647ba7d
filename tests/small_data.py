"""Hand-written rows with edge cases, and the three models built from them."""

from __future__ import annotations

from functools import cached_property

from caseloom import schemas
from caseloom.operators import bucket, clean, graph, star
from caseloom.operators.models import Buckets, Graph, Star

REGIONS = [
    ("AA", "ALPHA", "North", "Upper", 10.5, -20.25),
    ("BB", "BETA", "North", "Lower", 11.0, -21.0),
    ("CC", "GAMMA", "South", "Lower", 12.0, -22.0),
    ("DD", "DELTA", "South", "Lower", 13.0, -23.0),
]
DISEASES = [
    ("MEASLES", "Viral", "Airborne", "true", 1963),
    ("MUMPS", "Viral", "Airborne", "TRUE", 1967),
    ("DIPHTHERIA", "Bacterial", "Airborne", "no", 1923),
    ("SMALLPOX", "Viral", "Contact", None, 1796),
]
POPULATIONS = [
    ("AA", 1950, 1_000_000, "census"), ("AA", 1960, 1_200_000, "census"),
    ("AA", 1970, 1_100_005, "census"), ("BB", 1960, 500_000, "census"),
]
BORDER_LISTS = [("AA", "BB CC"), ("BB", "AA  ZZ"), ("CC", " AA"), ("AA", "BB")]


def row(week, state, loc, kind, disease, cases, rate="1.0"):
    return (str(week) if week is not None else None, state, loc, kind, disease, cases, rate)


RAW = [
    row(196001, "AA", "AA", "STATE", "MEASLES", "120", "12.34565"),
    row(196002, " aa ", None, "state", " measles\t", "80", "n/a"),
    row(196053, "AA", "AA", "STATE", "MEASLES", "7", "0.7"),
    row(196000, "AA", "AA", "STATE", "MEASLES", "3", "0.3"),
    row(196101, "AA", "AA", "STATE", "MEASLES", "100", "5"),
    row(196201, "AA", "AA", "STATE", "MEASLES", "50", "5"),
    row(196401, "AA", "AA", "STATE", "MEASLES", "25", "5"),
    row(196001, "BB", "BB", "STATE", "MEASLES", "200", "2"),
    row(196006, "BB", "BB", "STATE", "MEASLES", "300", "2"),
    row(196010, "CC", "CC", "STATE", "MEASLES", "60", "2"),
    row(196001, "AA", "AA", "STATE", "MUMPS", "150", "1"),
    row(196001, "BB", "BB", "STATE", "MUMPS", "150", "1"),
    row(196010, "CC", "CC", "STATE", "MUMPS", "0.5", "1"),
    # City rows: one is named like a state code, one lies in an unknown state.
    row(196003, "AA", "Springfield", "CITY", "DIPHTHERIA", "10", "1"),
    row(196003, "BB", "AA", "CITY", "DIPHTHERIA", "20", "2"),
    row(196003, "XX", "NOWHERE", "CITY", "DIPHTHERIA", "30", "3"),
    # Unknown state and unknown disease.
    row(196004, "XX", "XX", "STATE", "MEASLES", "40", "4"),
    row(196004, "AA", "AA", "STATE", "COWPOX", "44", "4"),
    # A grain that is neither: it counts where its (state, place) is a city.
    row(196003, "AA", "SPRINGFIELD", "COUNTY", "DIPHTHERIA", "5", "1"),
    row(196003, "AA", "ELSEWHERE", "COUNTY", "DIPHTHERIA", "6", "1"),
    # Rows that cleaning drops.
    row(196005, "AA", "AA", "STATE", "MEASLES", None),
    row(196005, "AA", "AA", "STATE", "MEASLES", "abc"),
    row(196005, "AA", "AA", "STATE", "MEASLES", "10d"),
    row(196005, "AA", "AA", "STATE", "MEASLES", "NaN"),
    row(196005, "AA", "AA", "STATE", "MEASLES", "0"),
    row(196005, "AA", "AA", "STATE", "MEASLES", "-3"),
    row(196005, "AA", "AA", "STATE", None, "9"),
    row(None, "AA", "AA", "STATE", "MEASLES", "9"),
    row("soon", "AA", "AA", "STATE", "MEASLES", "9"),
]
DROPPED = 9


class SmallData:
    def __init__(self, spark):
        self.spark = spark
        self.raw = spark.createDataFrame(RAW, schemas.RAW)
        self.regions = spark.createDataFrame(REGIONS, schemas.REGIONS)
        self.diseases = spark.createDataFrame(DISEASES, schemas.DISEASES)
        self.populations = spark.createDataFrame(POPULATIONS, schemas.POPULATIONS)
        self.border_lists = spark.createDataFrame(BORDER_LISTS, schemas.BORDER_LISTS)
        self.obs = clean.clean_observations(self.raw).cache()

    @cached_property
    def _models(self):
        return {"star": self.star(self.obs), "buckets": self.buckets(self.obs),
                "graph": self.graph(self.obs)}

    def star(self, obs=None) -> Star:
        if obs is None:
            return self._models["star"]
        time = star.build_dim_time(obs).cache()
        location = star.build_dim_location(obs, self.regions).cache()
        disease = star.build_dim_disease(self.diseases).cache()
        fact = star.build_fact(obs, time, location, disease, self.populations).cache()
        return Star(fact, time, location, disease)

    def buckets(self, obs=None) -> Buckets:
        if obs is None:
            return self._models["buckets"]
        return Buckets(bucket.build_buckets(obs, self.regions, self.diseases).cache(),
                       bucket.bucket_rows(obs).cache())

    def graph(self, obs=None) -> Graph:
        if obs is None:
            return self._models["graph"]
        nodes = {"Disease": graph.disease_nodes(self.diseases),
                 **graph.place_nodes(star.build_dim_location(obs, self.regions), self.regions),
                 **graph.calendar_nodes(star.build_dim_time(obs)),
                 "Observation": graph.observation_nodes(obs, self.regions, self.diseases).cache()}
        nodes["MonthlyAggregate"] = graph.monthly_aggregates(
            nodes["Observation"], self.regions).cache()
        return Graph(nodes, graph.border_edges(self.border_lists, self.regions), self.regions)

    def weekly(self, rows):
        """Clean state-grain observations from (week, state, disease, cases)."""
        return self.spark.createDataFrame(
            [(week, state, state, disease, cases, 1.0, "STATE") for week, state, disease, cases in rows],
            schemas.OBSERVATIONS)
