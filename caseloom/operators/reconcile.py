"""Comparison of two answers, table profiles and the overview."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom.functions.rounding import half_up


def side_by_side(left: DataFrame, right: DataFrame, keys: Sequence[str],
                 values: Sequence[str], names: tuple[str, str] = ("left", "right")) -> DataFrame:
    """Full outer join on the keys: both values, their difference, and where the row exists."""
    a, b = names
    l = left.select(*keys, *[F.col(v).alias(f"{a}_{v}") for v in values], F.lit(1).alias("_l"))
    r = right.select(*keys, *[F.col(v).alias(f"{b}_{v}") for v in values], F.lit(1).alias("_r"))
    presence = (F.when(F.col("_r").isNull(), F.lit(a)).when(F.col("_l").isNull(), F.lit(b))
                .otherwise(F.lit("both")).alias("present_in"))
    columns = []
    for v in values:
        lv, rv = F.col(f"{a}_{v}"), F.col(f"{b}_{v}")
        columns += [lv, rv, (rv - lv).alias(f"delta_{v}")]
    return l.join(r, list(keys), "full").select(*keys, *columns, presence)


def row_differences(left: DataFrame, right: DataFrame,
                    names: tuple[str, str] = ("left", "right")) -> DataFrame:
    """Rows held by one side only, with multiplicity, labelled with that side."""
    right = right.select(*left.columns)
    return (left.exceptAll(right).withColumn("only_in", F.lit(names[0]))
            .unionByName(right.exceptAll(left).withColumn("only_in", F.lit(names[1]))))


def profile(tables: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """Rows (kind, name, row_count) for every table, document set, node label and edge type."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(kind).alias("kind"), F.lit(name).alias("name"), "row_count")
        for kind, group in tables.items() for name, df in group.items()]
    return reduce(DataFrame.unionByName, counts)


def totals_by(answers: DataFrame, by: str, value: str = "total_cases") -> DataFrame:
    """Totals of ``value`` by one key, in key order."""
    return answers.groupBy(by).agg(F.sum(value).alias("total_cases")).orderBy(by)


def totals_with_share(answers: DataFrame, by: str, value: str = "total_cases") -> DataFrame:
    """Totals by one key, largest first, with their whole-number share of the grand total.

    The grand total is a window over the per-key totals, not over the rows.
    """
    totals = answers.groupBy(by).agg(F.sum(value).alias("total_cases"))
    everything = Window.partitionBy()
    share = F.col("total_cases") / F.nullif(F.sum("total_cases").over(everything), F.lit(0)) * 100
    return totals.withColumn("share_pct", half_up(share, 0)).orderBy(F.desc("total_cases"), by)
