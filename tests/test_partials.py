"""Partial states of the summaries: refreshed by decade, and mergeable distinct counts."""

import pytest
from pyspark.sql import functions as F

from caseloom.operators import clean, partials
from caseloom.plans.warehouse import Sources, Warehouse
from caseloom.sources import binding, tables


@pytest.fixture(scope="module")
def warehouse(spark, sf_dir, tmp_path_factory):
    def sources():
        return Sources(clean.typed_observations(binding.observations(spark, sf_dir)), binding.regions(spark, sf_dir),
                       binding.diseases(spark, sf_dir), binding.populations(spark, sf_dir),
                       binding.border_lists(spark, sf_dir))
    return Warehouse(spark, str(tmp_path_factory.mktemp("partials")), sources)


def rows_of(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def same_as_rebuilt(wh):
    for name in partials.FROM_STATES:
        rebuilt = wh.summary_builders()[name]()
        assert rows_of(wh.state_table(name).select(*rebuilt.columns)) == rows_of(rebuilt), name


def test_a_replaced_decade_is_refreshed_alone(spark, warehouse):
    wh = warehouse
    wh.refresh_decades()
    same_as_rebuilt(wh)
    fact = wh.table("fact")
    changed = fact.filter((F.col("decade") == 1990) & (F.col("case_count") % 2 == 0)).withColumn(
        "case_count", (F.col("case_count") + 3).cast("int"))
    partitions = [r.asDict() for r in fact.filter("decade = 1990").select(
        "loc_type", "decade", "disease_key").distinct().collect()]
    tables.refresh_partitions(changed, wh.path("fact"), fact.schema, ["loc_type", "decade", "disease_key"], partitions)
    other = tables.read_table(spark, f"{wh.root}/states/place_months", wh.state_table("place_months").schema)
    before = {f for f in other.inputFiles() if "decade=1990" not in f}
    wh.refresh_decades([1990])
    same_as_rebuilt(wh)
    after = set(tables.read_table(spark, f"{wh.root}/states/place_months", other.schema).inputFiles())
    assert before and before <= after
    plan = wh._state_builders([1990])["place_months"]()._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.split("\n") if "FileScan" in line and "case_count" in line)
    assert "PartitionFilters: [" in scan and "(decade" in scan and "1990" in scan


def test_a_decade_without_rows_disappears(spark, warehouse):
    wh = warehouse
    wh.state_table("place_months")
    fact = wh.table("fact")
    decades = sorted(r["decade"] for r in fact.select("decade").distinct().collect())
    last = decades[-1]
    partitions = [r.asDict() for r in fact.filter(F.col("decade") == last).select(
        "loc_type", "decade", "disease_key").distinct().collect()]
    tables.refresh_partitions(fact.limit(0), wh.path("fact"), fact.schema, ["loc_type", "decade", "disease_key"], partitions)
    wh.refresh_decades([last])
    assert wh.state_table("place_months").filter(F.col("decade") == last).isEmpty()
    same_as_rebuilt(wh)


def test_sketches_merge_upward(spark, warehouse):
    wh = warehouse
    sketches, states = wh.state_table("place_sketches"), wh.state_table("place_months")
    places = wh.table("dim_location").select("location_key", "state_code", "census_region")
    named = states.join(places, "location_key").join(wh.table("dim_disease").select("disease_key", "disease_name"),
                                                     "disease_key")
    for keys in (["disease_name", "decade"], ["disease_name", "census_region", "year"], ["month"], []):
        for of, column in (("states", "state_code"), ("places", "location_key")):
            exact = {tuple(r)[:-1]: r[-1] for r in named.groupBy(*keys).agg(F.count_distinct(column)).collect()}
            near = {tuple(r)[:-1]: r[-1] for r in partials.estimated(sketches, *keys, of=of).collect()}
            assert near.keys() == exact.keys()
            assert all(abs(near[k] - n) <= max(1, 0.05 * n) for k, n in exact.items())
    exact = wh.summary_builders()["summary_monthly_by_region"]()
    near = partials.estimated(partials.bucket_sketches(wh.buckets()), "disease", "region", "year", "month")
    both = exact.join(near, ["disease", "region", "year", "month"], "full")
    assert both.filter("estimate is null or abs(estimate - states_reporting) > 1").isEmpty()


def test_estimates_of_many_values(spark):
    rows = spark.range(200_000).select((F.col("id") % 10).cast("int").alias("month"), F.col("id").cast("string").alias("state"))
    sketches = rows.groupBy("month").agg(F.hll_sketch_agg("state").alias("states"))
    for keys, n in ((["month"], 20_000), ([], 200_000)):
        assert all(abs(r[-1] - n) < 0.06 * n for r in partials.estimated(sketches, *keys).collect())
