import random
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseloom.functions import epiweek, guards, nested, rounding, text


def _values():
    rng = random.Random(7)
    ties = [0.125, 2.675, 1.005, 0.5, 1.5, 2.5, 68.42345, 68.42355, 1e-9, 0.0, 123456.785, -2.5,
            -0.125, -1.005]
    fives = [rng.randrange(10 ** 8) / 1e5 for _ in range(3000)]
    return ties + fives + [rng.uniform(-1e6, 1e6) for _ in range(1000)]


@pytest.mark.parametrize("digits", [0, 1, 2, 4])
def test_half_even_equals_exact_rounding(spark, digits):
    df = spark.createDataFrame([(v,) for v in _values()], "x double")
    for r in df.select("x", rounding.half_even(F.col("x"), digits).alias("y")).collect():
        assert r.y == round(r.x, digits), r


def test_scaled_even_equals_numpy(spark):
    df = spark.createDataFrame([(v,) for v in _values()], "x double")
    rows = df.select("x", rounding.scaled_even(F.col("x"), 4).alias("y")).collect()
    assert [r.y for r in rows] == list(np.round(np.array([r.x for r in rows]), 4))


def test_half_up_rounds_the_shortest_text(spark):
    df = spark.createDataFrame([(v,) for v in _values()], "x double")
    for r in df.select("x", rounding.half_up(F.col("x"), 2).alias("y")).collect():
        assert r.y == float(Decimal(repr(r.x)).quantize(Decimal("0.01"), ROUND_HALF_UP)), r


def test_exact_ratio_keeps_ties(spark):
    df = spark.createDataFrame([(1, 800), (-1, 800), (1, 3)], "a long, b long")
    change = rounding.half_up(rounding.exact_ratio(F.col("a") * 100, F.col("b")), 2)
    assert [r[0] for r in df.select(change).collect()] == [0.13, -0.13, 33.33]


def test_time_fields(spark):
    weeks = [190001, 196052, 196053, 196000, 196054, 199927, 200005]
    df = epiweek.with_time_fields(spark.createDataFrame([(w,) for w in weeks], "epi_week int"))
    for r in df.collect():
        year, week = divmod(r.epi_week, 100)
        month = min(12, max(1, (week - 1) * 12 // 52 + 1))
        assert (r.year, r.week_number, r.month) == (year, week, month)
        assert r.month_name == epiweek.MONTH_NAMES[month - 1]
        assert (r.quarter, r.decade, r.century) == ((month - 1) // 3 + 1, year // 10 * 10, year // 100)
        assert r.is_summer == (month in (6, 7, 8))
        assert r.is_flu_season == (month in (10, 11, 12, 1, 2, 3))


def test_month_of_every_week(spark):
    df = spark.range(1, 54).select(F.col("id").cast("int").alias("w"),
                                   epiweek.month_of(F.col("id") + 195000).alias("m"))
    for r in df.collect():
        assert r.m == min(12, int((r.w - 1) * 12 / 52) + 1)


def test_numbers_from_text(spark):
    cases = {"12": 12.0, " 7 ": 7.0, "1e3": 1000.0, ".5": 0.5, "5.": 5.0, "-3": -3.0, "10d": None,
             "1_0": None, "0x10": None, "inf": None, "NaN": None, "": None, "abc": None}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: r.n for r in df.select("t", text.number_or_null(F.col("t")).alias("n")).collect()}
    assert got == cases


def test_tidy_strips_every_kind_of_space(spark):
    df = spark.createDataFrame([("\t New York \n",), (None,)], "t string")
    assert [r[0] for r in df.select(text.tidy(F.col("t"))).collect()] == ["NEW YORK", None]


def test_true_text(spark):
    df = spark.createDataFrame([("true",), ("True",), ("yes",), (None,)], "t string")
    assert [r[0] for r in df.select(text.true_text(F.col("t"))).collect()] == [True, True, False, False]


def test_guards(spark):
    df = spark.createDataFrame([(0,), (4,), (None,)], "x int")
    rows = df.select(guards.null_if_zero(F.col("x")), guards.one_if_zero(F.col("x")),
                     guards.at_least_one(F.col("x")),
                     guards.when_usable(F.col("x"), F.lit("y"))).collect()
    assert [tuple(r) for r in rows] == [(None, 1, 1, None), (4, 4, 4, "y"), (None, None, 1, None)]


def test_nested_expressions(spark):
    df = spark.sql("SELECT array(named_struct('d', 'A', 'n', 3L), named_struct('d', 'B', 'n', 1L)) AS a, "
                   "cast(array() AS array<struct<d:string,n:bigint>>) AS e")
    row = df.select(nested.total_of(F.col("a"), "n"), nested.share_profile(F.col("a"), "d", "n", 1),
                    nested.has_at_least(F.col("a"), 2), nested.first_of(F.col("a"))["d"],
                    nested.first_of(F.col("e"))).first()
    assert row[0] == 4 and [tuple(p) for p in row[1]] == [("A", 75.0), ("B", 25.0)]
    assert row[2] is True and row[3] == "A" and row[4] is None
