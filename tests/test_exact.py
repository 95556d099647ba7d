"""Exact moments and ranks over whole tables."""

import math
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from caseloom.functions import moments
from caseloom.operators import ranking


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.range(20_000).select(
        (F.col("id") % 7).alias("g"), ((F.col("id") * F.col("id")) % 10_007 * 900_001).alias("x"),
        F.when(F.col("id") % 11 != 0, (F.col("id") * 37) % 5_003 + F.col("id")).alias("y"))


def summary(df):
    x, y = F.col("x"), F.col("y")
    return [tuple(r) for r in df.groupBy("g").agg(
        moments.mean(y), moments.deviation(x), moments.deviation(y, sample=False),
        moments.correlation(x, y)).orderBy("g").collect()]


def test_bits_do_not_depend_on_partitions(numbers):
    wanted = summary(numbers)
    for seed in range(10):
        dealt = numbers.repartition(3 + seed, F.xxhash64("x", F.lit(seed)))
        assert summary(dealt) == wanted
    rows = [r for r in numbers.collect() if r["g"] == 3]
    ys = [r["y"] for r in rows if r["y"] is not None]
    assert wanted[3][1] == sum(ys) / len(ys)
    assert math.isclose(wanted[3][2], statistics.stdev(r["x"] for r in rows), rel_tol=1e-12)
    assert math.isclose(wanted[3][3], statistics.pstdev(ys), rel_tol=1e-12)
    both = [(r["x"], r["y"]) for r in rows if r["y"] is not None]
    assert math.isclose(wanted[3][4], statistics.correlation(*zip(*both)), rel_tol=1e-9)


def test_moments_of_few_values(spark):
    rows = spark.createDataFrame([("one", 5, 5), ("flat", 2, 1), ("flat", 2, 9), ("none", None, 1)], "g string, x long, y long")
    got = {r[0]: tuple(r)[1:] for r in rows.groupBy("g").agg(
        moments.mean(F.col("x")), moments.deviation(F.col("x")), moments.deviation(F.col("x"), sample=False),
        moments.correlation(F.col("x"), F.col("y"))).collect()}
    assert got == {"one": (5.0, None, 0.0, None), "flat": (2.0, 0.0, 0.0, None), "none": (None, None, None, None)}
    window = Window.partitionBy("g")
    assert rows.select(moments.mean(F.col("y"), window)).distinct().count() == 2


def test_ranks_of_a_million_rows_with_heavy_ties(spark):
    key = F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 1_000 == 1, None).otherwise((F.col("id") * 7_919) % 50_021)
    rows = spark.range(1_000_000).select("id", key.alias("k")).repartition(8)
    ranked = ranking.ranks(rows, ["k"], descending=True)
    placed = ranking.ordinals(ranked, [F.col("k").desc(), F.col("id").asc()])
    for df in (ranked, placed):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan
    order = Window.orderBy(F.col("k").desc(), "id")
    wanted = rows.select("id", F.rank().over(Window.orderBy(F.col("k").desc())).alias("r"),
                         F.row_number().over(order).alias("o"))
    both = placed.join(wanted, "id")
    assert both.count() == 1_000_000 and both.filter("rank != r or ordinal != o").isEmpty()


def test_ranks_of_several_keys_and_no_rows(spark):
    rows = spark.createDataFrame([("b", 1), ("a", 2), ("a", 2), ("a", 1), (None, 3), (None, 3)], "s string, n int")
    got = sorted((r["s"] or "", r["n"], r["rank"]) for r in ranking.ranks(rows, ["s", "n"]).collect())
    assert got == [("", 3, 1), ("", 3, 1), ("a", 1, 3), ("a", 2, 4), ("a", 2, 4), ("b", 1, 6)]
    assert ranking.ranks(rows.limit(0), ["s"]).count() == 0
    assert ranking.ordinals(rows.limit(0), [F.col("s").asc()]).count() == 0
    assert sorted(r["ordinal"] for r in ranking.ordinals(rows, [F.col("s").asc()]).collect()) == [1, 2, 3, 4, 5, 6]
