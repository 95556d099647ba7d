"""Physical plans: what is scanned, joined and shuffled."""

import re

import pytest

from caseloom.operators import bucket, graph
from caseloom.plans import registry


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def tree(df) -> str:
    return plan(df).split("\n\n")[0]


@pytest.fixture(scope="module")
def answer(spark, sf_dir):
    queries = registry.all_queries()
    return lambda name: queries[name](spark, sf_dir)


@pytest.fixture(scope="module")
def warehouse(spark, sf_dir):
    return registry.bound_warehouse(spark, sf_dir)


@pytest.mark.parametrize("number", range(1, 11))
def test_star_queries_broadcast_dimensions(answer, number):
    text = tree(answer(f"q{number:02d}_star"))
    assert "BroadcastHashJoin" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["q08_star", "q09_star", "q10_star", "q05_star", "q06_star", "q07_star"])
def test_one_fact_scan_runs(answer, name):
    df = answer(name)
    df.collect()
    executed = df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet \[[^\]]*case_count", executed)) == 1


@pytest.mark.parametrize("name", ["graph_calendar_edges", "graph_place_edges", "q01_graph_paths"])
def test_graph_sets_come_from_the_dimensions(answer, name):
    assert not re.search(r"Location: .*/observations\b", plan(answer(name)))


def test_fact_scan_is_pruned(answer):
    text = plan(answer("q02_star"))
    scan = [part for part in text.split("\n\n") if re.search(r"Location: .*/fact\b", part)][0]
    filters = re.search(r"PartitionFilters: (.*)", scan).group(1)
    assert "loc_type" in filters and "decade" in filters and "dynamicpruning" in filters
    columns = re.search(r"ReadSchema: struct<(.*)>", scan).group(1)
    assert columns == "location_key:int,case_count:int,incidence_rate:decimal(12,4),year:int"
    assert "(year,1998)" in scan


def test_bucket_scan_reads_nested_fields_only(answer):
    text = plan(answer("q02_bucket"))
    read = re.search(r"ReadSchema: (.*)", text).group(1)
    assert "weekly_observations" not in read and "coordinates" not in read and "category" not in read
    pushed = re.search(r"PushedFilters: (.*)", text).group(1)
    assert "EqualTo(disease.name,STANDARD)" in pushed


def test_graph_scan_pushes_the_disease(answer):
    text = plan(answer("q03_graph"))
    assert "EqualTo(disease,STANDARD)" in text and "observation_count" not in re.search(
        r"ReadSchema: (.*)", text).group(1)


@pytest.mark.parametrize("name", ["q11_graph", "q11_graph_all_pairs", "q06_star", "q06_graph"])
def test_pair_queries_use_equality_joins(answer, name):
    text = tree(answer(name))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["q03_star", "q03_bucket", "q03_graph", "q06_graph", "q09_star",
                                  "q09_bucket", "q09_graph", "q11_graph"])
def test_limits_are_top_k(answer, name):
    assert "TakeOrderedAndProject" in tree(answer(name))


def test_no_python_in_any_plan(answer):
    for name in registry.all_queries():
        if name.startswith(("stream_", "refresh_", "graph_write")):
            continue
        text = tree(answer(name))
        assert "ArrowEvalPython" not in text and "BatchEvalPython" not in text, name


def test_aggregates_combine_before_the_shuffle(warehouse):
    obs = warehouse.table("observations")
    for df in (bucket.build_buckets(obs, warehouse.table("regions"), warehouse.table("diseases")),
               graph.monthly_aggregates(warehouse.table("observation_nodes"), warehouse.table("regions"))):
        lines = tree(df).splitlines()
        first = next(i for i, line in enumerate(lines) if "Exchange" in line and "Broadcast" not in line)
        assert "HashAggregate" in lines[first + 1]


def test_no_join_hint_forces_a_broadcast(spark, sf_dir):
    """Without a size bound that fits, every model still builds with shuffled joins."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wh = registry.bound_warehouse(spark, sf_dir)
        text = tree(wh.star().rows("disease", "time", "location"))
        assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
