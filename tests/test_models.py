from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from caseloom import schemas
from caseloom.operators import graph, summaries
from caseloom.operators.models import Buckets
from caseloom.plans import bucket_queries


def test_dim_time_is_dense_in_week_order(small):
    rows = sorted(small.star().dim_time.collect(), key=lambda r: r.time_key)
    weeks = [r.epi_week for r in rows]
    assert weeks == sorted({r.epi_week for r in small.obs.collect()})
    assert [r.time_key for r in rows] == list(range(1, len(rows) + 1))


def test_dim_location_covers_states_then_cities(small):
    rows = sorted(small.star().dim_location.collect(), key=lambda r: r.location_key)
    assert [(r.loc_type, r.state_code, r.city_name) for r in rows] == [
        ("STATE", "AA", None), ("STATE", "BB", None), ("STATE", "CC", None), ("STATE", "XX", None),
        ("CITY", "AA", "SPRINGFIELD"), ("CITY", "BB", "AA"), ("CITY", "XX", "NOWHERE")]
    assert [r.location_key for r in rows] == list(range(1, 8))
    unknown = rows[3]
    assert unknown.state_name is None and unknown.latitude is None


def test_dim_disease(small):
    rows = sorted(small.star().dim_disease.collect(), key=lambda r: r.disease_key)
    assert [r.disease_name for r in rows] == ["DIPHTHERIA", "MEASLES", "MUMPS", "SMALLPOX"]
    assert [r.is_vaccine_preventable for r in rows] == [False, True, True, False]


def test_fact_resolves_each_grain(small):
    star = small.star()
    rows = (star.fact.join(star.dim_location.drop("loc_type"), "location_key")
            .join(star.dim_disease, "disease_key").join(star.dim_time.drop("decade"), "time_key")).collect()
    # Dropped: the unknown disease and the place that is no city.
    assert len(rows) == small.obs.count() - 2
    diphtheria = {(r.state_code, r.city_name, r.case_count, r.population, r.loc_type)
                  for r in rows if r.disease_name == "DIPHTHERIA"}
    assert diphtheria == {("AA", "SPRINGFIELD", 10, None, "CITY"), ("AA", "SPRINGFIELD", 5, None, "CITY"),
                          ("BB", "AA", 20, None, "CITY"), ("XX", "NOWHERE", 30, None, "CITY")}
    people = {(r.state_code, r.population) for r in rows if r.loc_type == "STATE"}
    assert people == {("AA", 1_200_000), ("BB", 500_000), ("CC", None), ("XX", None)}
    first = [r for r in rows if r.epi_week == 196001 and r.state_code == "AA"
             and r.disease_name == "MEASLES"][0]
    assert str(first.incidence_rate) == "12.3457"
    assert len({r.incidence_key for r in rows}) == len(rows)


def test_bucket_documents(small):
    docs = small.buckets().documents.collect()
    keys = {(r.disease.name, r.location.state_code, r.location.city, r.location.loc_type,
             r.time_bucket.year, r.time_bucket.month) for r in docs}
    assert ("COWPOX", "AA", None, "STATE", 1960, 1) in keys
    assert ("MEASLES", "XX", None, "STATE", 1960, 1) in keys
    cowpox = [r for r in docs if r.disease.name == "COWPOX"][0]
    assert (cowpox.disease.category, cowpox.disease.vaccine_preventable, cowpox.disease.vaccine_year) == ("", False, None)
    unknown = [r for r in docs if r.location.state_code == "XX" and r.location.loc_type == "STATE"][0]
    assert (unknown.location.state_name, unknown.location.region) == ("XX", "")
    assert unknown.location.coordinates.lat is None
    # 'NAN' and 'AA' are different places, so the same month has two documents.
    january = [r for r in docs if r.disease.name == "MEASLES" and r.location.state_code == "AA"
               and (r.time_bucket.year, r.time_bucket.month) == (1960, 1)]
    assert sorted(len(r.weekly_observations) for r in january) == [1, 2]
    weeks = max(january, key=lambda r: len(r.weekly_observations)).weekly_observations
    assert [w.epi_week for w in weeks] == [196000, 196001]
    assert weeks[1].incidence_rate == float(np.round(12.34565, 4))


def test_a_hot_bucket_is_never_gathered(small):
    # One bucket holds a third of all rows, all of the same week.
    hot = small.weekly([(196001, "AA", "MEASLES", i + 1) for i in range(500)])
    cold = small.weekly([(196001 + i % 50, "BB", "MUMPS", i + 1) for i in range(1000)])
    model = small.buckets(hot.union(cold))
    assert model.weeks().count() == 1500
    largest = model.documents.agg(F.max(F.size("weekly_observations"))).first()[0]
    assert largest == 500
    assert bucket_queries.q04_bucket(model).first().avg_weekly_cases == 250.5
    for df in (bucket_queries.q04_bucket(model), summaries.weekly_by_region(model, small.regions)):
        assert "collect_list" not in df._jdf.queryExecution().toString()


def test_borders(small):
    pairs = {(r.src, r.dst) for r in graph.borders(small.border_lists).collect()}
    assert pairs == {("AA", "BB"), ("AA", "CC"), ("BB", "AA"), ("BB", "ZZ"), ("CC", "AA")}
    known = {(r.src, r.dst) for r in small.graph().borders.collect()}
    assert known == pairs - {("BB", "ZZ")}


def test_observation_nodes_need_known_ends(small):
    rows = small.graph().nodes["Observation"].collect()
    assert {(r.disease, r.state_code, r.city_name) for r in rows if r.grain == "CITY"} == {
        ("DIPHTHERIA", "AA", "SPRINGFIELD"), ("DIPHTHERIA", "BB", "AA"), ("DIPHTHERIA", "XX", "NOWHERE")}
    assert not [r for r in rows if r.grain == "STATE" and r.state_code == "XX"]
    assert not [r for r in rows if r.disease == "COWPOX"]
    assert len({r.observation_id for r in rows}) == len(rows)


def test_monthly_aggregates_roll_cities_up(small):
    model = small.graph()
    rows = {(r.disease, r.state_code, r.year, r.month): r for r in model.aggregates.collect()}
    assert rows["DIPHTHERIA", "AA", 1960, 1].total_cases == 15
    assert rows["DIPHTHERIA", "BB", 1960, 1].total_cases == 20
    assert ("DIPHTHERIA", "XX", 1960, 1) not in rows
    assert rows["MEASLES", "AA", 1960, 1].observation_count == 3
    paths = graph.aggregate_over_paths(
        model.nodes["Observation"], model.nodes["State"], model.nodes["City"]).collect()
    assert {(r.disease, r.state, r.year, r.month, r.total_cases, r.observation_count) for r in paths} == {
        (*k, r.total_cases, r.observation_count) for k, r in rows.items()}


def test_node_and_edge_sets(small):
    model = small.graph()
    assert set(model.nodes) == set(graph.NODE_LABELS)
    count = {label: df.count() for label, df in model.nodes.items()}
    assert (count["State"], count["Region"], count["Country"], count["City"]) == (4, 2, 1, 3)
    assert count["Quarter"] == 4 * count["Year"]
    edges = {k: graph.edges(k, model.nodes, model.regions, model.borders) for k in graph.EDGE_KINDS}
    assert edges["LOCATED_IN_STATE"].count() == 2
    assert edges["IN_QUARTER"].count() == count["Month"]
    assert edges["AFFECTS"].count() == count["Observation"]
    assert edges["OBSERVED_IN"].count() + edges["OBSERVED_IN_CITY"].count() == count["Observation"]
    # Every edge ends in a node.
    quarters = model.nodes["Quarter"].select((F.col("year") * 10 + F.col("quarter")).cast("string").alias("dst"))
    assert edges["IN_QUARTER"].join(quarters, "dst", "left_anti").isEmpty()


def test_totals_agree_across_models(small):
    star, docs, model = small.star(), small.buckets(), small.graph()
    known = defaultdict(int)
    for r in small.obs.collect():
        if r.disease != "COWPOX" and r.loc != "ELSEWHERE":
            known[r.disease] += r.cases
    fact = {r.disease_name: r.c for r in star.rows("disease", grain=None).groupBy("disease_name").agg(
        F.sum("case_count").alias("c")).collect()}
    assert fact == dict(known)
    total = docs.summaries().agg(F.sum("monthly_summary.total_cases")).first()[0]
    assert total == sum(r.cases for r in small.obs.collect())
    unwound = docs.documents.select(F.inline("weekly_observations")).agg(F.sum("cases")).first()[0]
    assert unwound == total
    nodes = model.nodes["Observation"].agg(F.sum("case_count")).first()[0]
    # Without the unknown state at state grain.
    assert nodes == sum(known.values()) - 40


def test_stored_schemas(small):
    assert small.star().fact.schema.simpleString() == schemas.FACT.simpleString()
    assert small.buckets().documents.schema.simpleString() == schemas.DOCUMENTS.simpleString()
    assert small.graph().aggregates.schema.simpleString() == schemas.MONTHLY_AGGREGATES.simpleString()
