import copy
import statistics

import pytest
from pyspark.sql import functions as F

from caseloom.operators import olap, reconcile, summaries
from caseloom.plans import bucket_queries, graph_queries, star_queries


def test_q01_on_each_model(small):
    star = {(r.disease_name, r.decade): r for r in star_queries.q01_star(small.star()).collect()}
    assert ("DIPHTHERIA", 1960) not in star
    assert star["MEASLES", 1960].total_cases == 120 + 80 + 7 + 3 + 100 + 50 + 25 + 200 + 300 + 60 + 40
    docs = {(r.disease_name, r.decade): r for r in bucket_queries.q01_bucket(small.buckets()).collect()}
    assert docs["DIPHTHERIA", 1960].total_cases == 71 and docs["COWPOX", 1960].total_cases == 44
    graph = {(r.disease_name, r.decade): r for r in graph_queries.q01_graph(small.graph()).collect()}
    assert graph["DIPHTHERIA", 1960].total_cases == 35


def test_q02_and_q03_order_and_limit(small):
    rows = star_queries.q02_star(small.star(), 1960).collect()
    assert [(r.state_name, r.total_cases) for r in rows] == [("BETA", 500), ("ALPHA", 210), ("GAMMA", 60), (None, 40)]
    top = star_queries.q03_star(small.star(), "MEASLES", 1960, 1961, k=2).collect()
    assert [(r.state_name, r.total_cases) for r in top] == [("BETA", 500), ("ALPHA", 310)]


def test_q03_ties_at_the_limit_are_stable(small):
    obs = small.weekly([(196001, s, "MEASLES", 5) for s in ("CC", "AA", "BB")])
    rows = star_queries.q03_star(small.star(obs), "MEASLES", 1960, 1960, k=2).collect()
    assert [r.state_name for r in rows] == ["ALPHA", "BETA"]


def test_q04_integer_division_on_the_graph(small):
    obs = small.weekly([(196001, "AA", "MEASLES", 5), (196002, "AA", "MEASLES", 6)])
    assert star_queries.q04_star(small.star(obs)).first().avg_weekly_cases == 5.5
    assert bucket_queries.q04_bucket(small.buckets(obs)).first().avg_weekly_cases == 5.5
    assert graph_queries.q04_graph(small.graph(obs)).first().avg_weekly_cases == 5.0


def test_q05_year_over_year(small):
    star = star_queries.q05_star(small.star()).filter("state_name = 'ALPHA'").collect()
    assert [(r.year, r.total_cases, r.prev_year_cases, r.yoy_pct_change) for r in star] == [
        (1960, 210, None, None), (1961, 100, 210, -52.38), (1962, 50, 100, -50.0), (1964, 25, 50, -50.0)]
    graph = graph_queries.q05_graph(small.graph()).collect()
    assert {r.state_name for r in graph} == {"ALPHA"} and len(graph) == 3


def test_q05_previous_year_zero(small):
    obs = small.weekly([(196001, "AA", "MEASLES", 0), (196101, "AA", "MEASLES", 7)])
    second = [q.filter("year = 1961").first().yoy_pct_change for q in (
        star_queries.q05_star(small.star(obs)), bucket_queries.q05_bucket(small.buckets(obs)),
        graph_queries.q05_graph(small.graph(obs)))]
    assert second == [None, None, 700.0]


def _co_occurring(small, constant=False):
    rows = []
    for year in range(1950, 1962):
        rows += [(year * 100 + 1, "AA", "MEASLES", 200 + 10 * (year - 1950)),
                 (year * 100 + 1, "AA", "MUMPS", 300 if constant else 900 - 7 * (year % 5))]
    return small.weekly(rows)


def test_q06_correlation(small):
    obs = _co_occurring(small)
    row = star_queries.q06_star(small.star(obs)).first()
    x = [200 + 10 * i for i in range(12)]
    y = [900 - 7 * (year % 5) for year in range(1950, 1962)]
    assert (row.disease_a, row.disease_b, row.co_occurrence_count) == ("MEASLES", "MUMPS", 12)
    assert row.correlation == round(statistics.correlation(x, y), 3)
    docs = {r.disease_a: r.co_occurrence_count for r in bucket_queries.q06_bucket(small.buckets(obs)).collect()}
    assert docs == {"MEASLES": 12, "MUMPS": 12}
    pairs = graph_queries.q06_graph(small.graph(obs)).collect()
    assert [tuple(r) for r in pairs] == [("MEASLES", "MUMPS", 12)]


def test_q06_constant_column_has_no_correlation(small):
    row = star_queries.q06_star(small.star(_co_occurring(small, constant=True))).first()
    assert row.co_occurrence_count == 12 and row.correlation is None


def test_q06_needs_more_than_the_floor(small):
    few = small.weekly([(y * 100 + 1, "AA", d, 101) for y in range(1950, 1960) for d in ("MEASLES", "MUMPS")])
    assert star_queries.q06_star(small.star(few)).isEmpty()
    assert not graph_queries.q06_graph(small.graph(few)).isEmpty()


def test_q07_ranks(small):
    obs = small.weekly([(195001, "CC", "MEASLES", 1), (195001, "BB", "MEASLES", 1),
                        (195101, "AA", "MEASLES", 1), (194001, "AA", "MEASLES", 0)])
    star = star_queries.q07_star(small.star(obs)).collect()
    assert [tuple(r) for r in star] == [("BETA", 1950, 1), ("GAMMA", 1950, 1), ("ALPHA", 1951, 3)]
    docs = bucket_queries.q07_bucket(small.buckets(obs)).collect()
    assert [tuple(r) for r in docs] == [("BETA", 1950, 1), ("GAMMA", 1950, 2), ("ALPHA", 1951, 3)]
    assert graph_queries.q07_graph(small.graph(obs)).columns == ["state_name", "first_reported_year"]


def test_q08_windows(small):
    rows = [(y * 100 + 1, "AA", "MEASLES", c) for y, c in
            [(1952, 999), (1953, 100), (1962, 300), (1963, 5000), (1964, 40), (1973, 60), (1974, 999)]]
    rows += [(196801, "AA", "MUMPS", 10)]
    star = {r.disease_name: r for r in star_queries.q08_star(small.star(small.weekly(rows))).collect()}
    assert tuple(star["MEASLES"])[1:] == (1963, 200.0, 50.0, -75.0)
    assert tuple(star["MUMPS"])[1:] == (1967, None, 10.0, None)
    assert tuple(star["SMALLPOX"])[1:] == (1796, None, None, None)
    docs = {r.disease_name: r for r in bucket_queries.q08_bucket(small.buckets(small.weekly(rows))).collect()}
    assert set(docs) == {"MEASLES", "MUMPS"}
    assert tuple(docs["MUMPS"])[1:] == (1967, 0.0, 10.0, 0.0)
    graph = {r.disease_name: r for r in graph_queries.q08_graph(small.graph(small.weekly(rows))).collect()}
    assert set(graph) == {"MEASLES", "MUMPS", "DIPHTHERIA"}
    assert tuple(graph["MUMPS"])[1:] == (1967, None, 10.0, None)


def test_q09_sample_and_population_deviation(small):
    states = [f"S{i:02d}" for i in range(20)]
    regions = small.spark.createDataFrame(
        [(s, s, "R", "D", 0.0, 0.0) for s in states], small.regions.schema)
    other = copy.copy(small)
    other.regions = regions
    totals = [10 + i for i in range(19)] + [200]
    obs = small.weekly([(196001, s, "MEASLES", c) for s, c in zip(states, totals)]
                       + [(196101, "S00", "MEASLES", 7)]
                       + [(196201, s, "MEASLES", 5) for s in states])
    mean = statistics.mean(totals)
    star = star_queries.q09_star(other.star(obs)).collect()
    assert [(r.state_name, r.year, r.z_score) for r in star] == [
        ("S19", 1960, round((200 - mean) / statistics.stdev(totals), 2))]
    docs = bucket_queries.q09_bucket(other.buckets(obs)).collect()
    assert docs[0].z_score == round((200 - mean) / statistics.pstdev(totals), 2)
    assert graph_queries.q09_graph(other.graph(obs)).first().z_score == star[0].z_score


def test_q10_peak(small):
    rows = star_queries.q10_star(small.star()).filter("disease_name = 'MEASLES'").collect()
    peak = max(r.total_cases for r in rows)
    assert [r.normalized_index for r in rows] == [round(r.total_cases / peak * 100, 2) for r in rows]
    zero = small.weekly([(196001, "AA", "MEASLES", 0)])
    assert star_queries.q10_star(small.star(zero)).first().normalized_index is None
    assert bucket_queries.q10_bucket(small.buckets(zero)).first().normalized_index == 0.0
    assert graph_queries.q10_graph(small.graph(zero)).first().normalized_index == 0.0


def test_q11_against_brute_force(small):
    weeks = [195001, 195006, 195010, 195040, 195052, 195101, 195110, 195125]
    obs = small.weekly([(w, s, "MEASLES", 40 + (7 * i + 13 * j) % 50)
                        for i, w in enumerate(weeks) for j, s in enumerate(("AA", "BB", "CC"))])
    model = small.graph(obs)
    months = [r for r in model.aggregates.collect() if r.total_cases > 50]
    borders = {(r.src, r.dst) for r in model.borders.collect()}
    expected = []
    for a in months:
        for b in months:
            lag = b.year * 12 + b.month - a.year * 12 - a.month
            if (a.state_code, b.state_code) in borders and 1 <= lag <= 6:
                expected.append((a.state_name, b.state_name, a.year, a.month, b.year, b.month, lag))
    got = [tuple(r) for r in graph_queries.q11_graph(model, "MEASLES", 50, k=None).collect()]
    assert sorted(got) == sorted(expected) and expected
    first = [tuple(r) for r in graph_queries.q11_graph(model, "MEASLES", 50, k=3).collect()]
    assert first == sorted(expected, key=lambda t: (t[6], *t[:4]))[:3]
    bars = graph_queries.lag_histogram(graph_queries.q11_graph(model, "MEASLES", 50, k=None)).collect()
    assert sum(r.pair_count for r in bars) == len(expected)


def test_q12_profile_and_q13_coverage(small):
    rows = {r.code: r for r in graph_queries.q12_graph(small.graph()).collect()}
    profile = {p.disease: p.pct for p in rows["AA"].profile}
    total = 385 + 150 + 15
    assert profile == {"MEASLES": round(385 / total * 100, 1), "MUMPS": round(150 / total * 100, 1),
                       "DIPHTHERIA": round(15 / total * 100, 1)}
    coverage = {r.disease_name: r for r in graph_queries.q13_graph(small.graph()).collect()}
    assert coverage["MEASLES"].state_year_presence == 2
    assert coverage["MEASLES"].coverage_pct == round(2 / 4050 * 100, 2)


def test_olap_errors(small):
    star = small.star()
    with pytest.raises(ValueError):
        olap.slice_summary(star, "planet", "X")
    with pytest.raises(ValueError):
        olap.dice(star, {"planet": "X"})
    with pytest.raises(ValueError):
        olap.drill_down(star, "week")
    with pytest.raises(ValueError):
        olap.roll_up(star, "decade")


def test_olap_grains(small):
    star = small.star()
    # A slice covers all grains, a dice state grain only.
    assert olap.slice_summary(star, "disease", "DIPHTHERIA").first().total_cases == 65
    assert olap.dice(star, {"disease": "DIPHTHERIA"}).isEmpty()
    wide = olap.pivot(star).first()
    assert wide.decade == 1960 and wide.diphtheria == 0 and wide.mumps == 300
    assert olap.pivot(star).columns[:6] == ["decade", "measles", "pertussis", "polio", "diphtheria", "hepatitis_a"]


def test_roll_up_of_drill_down_is_consistent(small):
    star = small.star()
    fine = olap.drill_down(star, "decade").groupBy("disease_name", "decade").agg(
        F.sum("total_cases").alias("total_cases"))
    assert fine.exceptAll(olap.roll_up(star, "year").select(fine.columns)).isEmpty()


def test_summaries_are_consistent(small):
    star = small.star()
    monthly = summaries.monthly_disease_state(star).agg(F.sum("total_cases")).first()[0]
    national = summaries.decade_disease_national(star).agg(
        F.sum("total_cases"), F.sum("cases_reported_at_city_grain")).first()
    assert national[0] == monthly + national[1] and national[1] == 65
    cities = summaries.yearly_disease_city(star).collect()
    assert {(r.city_name, r.total_cases) for r in cities} == {("SPRINGFIELD", 15), ("AA", 20), ("NOWHERE", 30)}
    docs = small.buckets()
    states = summaries.monthly_by_region(docs).agg(F.sum("total_cases")).first()[0]
    everything = summaries.monthly_by_region(docs, state_only=False).agg(F.sum("total_cases")).first()[0]
    weekly = summaries.weekly_by_region(docs, small.regions).agg(
        F.sum("total_cases"), F.sum("weeks_reporting")).first()
    assert everything == weekly[0] and weekly[1] == small.obs.count() and states < everything
    assert summaries.decade_national(docs).agg(F.sum("total_cases")).first()[0] == everything


def test_first_match_keeps_one_row_per_key(spark):
    lookup = spark.createDataFrame([("a", "z"), ("a", "b"), ("c", "d")], "k string, v string")
    assert {tuple(r) for r in summaries.first_match(lookup, "k", "v").collect()} == {("a", "b"), ("c", "d")}


def test_reconcile(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2)], "k string, v long")
    right = spark.createDataFrame([("b", 5), ("c", 3)], "k string, v long")
    rows = {r.k: (r.left_v, r.right_v, r.delta_v, r.present_in)
            for r in reconcile.side_by_side(left.distinct(), right, ["k"], ["v"]).collect()}
    assert rows == {"a": (1, None, None, "left"), "b": (2, 5, 3, "both"), "c": (None, 3, None, "right")}
    only = sorted(tuple(r) for r in reconcile.row_differences(left, right).collect())
    assert only == [("a", 1, "left"), ("b", 2, "left"), ("b", 2, "left"), ("b", 5, "right"), ("c", 3, "right")]


def test_shares(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 6)], "k string, total_cases long")
    assert [tuple(r) for r in reconcile.totals_with_share(df, "k").collect()] == [("b", 6, 75.0), ("a", 2, 25.0)]
