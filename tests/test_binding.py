"""The driver's tables as observations: what moves with every item, and the grouping by names."""

import datetime

from pyspark.sql import functions as F

from caseloom.functions import rounding
from caseloom.sources import binding

DAY = datetime.datetime(1996, 1, 9)


def write_tables(spark, folder):
    rows = {
        "region": ([(0, "ASIA")], "r_regionkey int, r_name string"),
        "nation": ([(0, "A", 0), (1, None, 0), (2, "C", None)], "n_nationkey int, n_name string, n_regionkey int"),
        # Key 5 comes twice, with two names; keys 6 and 7 share one.
        "supplier": ([(5, "S", 0), (5, "T", 0), (6, "U", 0), (7, "U", 0), (8, None, 0), (9, "V", 1), (4, "W", 2)],
                     "s_suppkey long, s_name string, s_nationkey int"),
        "part": ([(1, "PROMO"), (2, "SMALL"), (3, None)], "p_partkey long, p_type string"),
        "lineitem": ([(part, supplier, 2.0, price, DAY) for part in (1, 2, 3, None)
                      for supplier, price in ((5, 1.005), (6, 2.5), (7, 0.004), (8, -0.025), (9, 7.0), (4, 1.0))],
                     "l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_shipdate timestamp")}
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_names_group_and_repeated_keys_count(spark, tmp_path):
    found = binding.observations(spark, write_tables(spark, tmp_path / "t"))
    assert found.columns == ["disease", "state", "loc", "loc_type", "epi_week", "cases", "incidence_per_100000"]
    rows = {tuple(r)[:4]: (r["cases"], round(r["incidence_per_100000"] * 1e5, 6)) for r in found.collect()}
    promo = {("PROMO", "A", "S", "CITY"): (2, 100.0), ("PROMO", "A", "T", "CITY"): (2, 100.0),
             ("PROMO", "A", "U", "CITY"): (4, 125.0), ("PROMO", "A", None, "CITY"): (2, -3.0),
             ("PROMO", None, "V", "CITY"): (2, 700.0)}
    # Five items of nation A: 100 + 100 + 250 + 0 - 3 cents.
    rest = {(d, s, s, "STATE"): v for d in ("SMALL", None) for s, v in (("A", (10, 89.4)), (None, (2, 700.0)))}
    assert rows == {**promo, **rest} and found.select("epi_week").distinct().collect() == [(199602,)]


def test_groups_are_keyed_by_four_columns_and_small_parts_broadcast(spark, tmp_path):
    found = binding.observations(spark, write_tables(spark, tmp_path / "t"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    keys = [line.split("keys=[")[1].split("]")[0] for line in plan.splitlines() if "HashAggregate(keys=[" in line]
    assert keys and all(len(k.split(", ")) == 4 for k in keys)
    assert "BroadcastHashJoin [l_partkey" in plan and "ShuffledHashJoin" not in plan  # no hint stands in the way


def test_whole_half_up_equals_round(spark):
    values = [None, 0.0, 0.4, 0.5, 0.49999999999999994, 1.0, 1.5, 2.5, 2.4999999999999996, -0.5, -1.5, -2.5, 99.5,
              float(2 ** 50), float(2 ** 50) - 0.5, 4503599627370495.5, 8419703.999999999, 1e17, 100.49999999999999]
    values += [(k * 7919 % 10_000_019) / 1000.0 for k in range(2000)]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    same = rounding.whole_half_up(F.col("v")).eqNullSafe(F.round("v").cast("long"))
    assert rows.where(~same).count() == 0
