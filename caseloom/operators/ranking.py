"""Ranks over a whole table without one task that holds it."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.session import scratch_root
from caseloom.sources.tables import read_table, write_table


def _dealt(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` in ranges of the order, numbered by ``_part`` and stored.

    The borders come from a sample, so the ranges are written before they are counted and
    numbered: both must see the same ones, also after a lost executor.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    path = f"{scratch_root(spark)}/ranges/{uuid.uuid4().hex[:12]}"
    write_table(ranged, path)
    return read_table(spark, path, ranged.schema)


def _offset(dealt: DataFrame, size: Column) -> Column:
    """How much is in all ranges before a row's own; one number per range reaches the driver."""
    sizes = sorted((r["_part"], r["n"]) for r in dealt.groupBy("_part").agg(F.sum(size).alias("n")).collect())
    before, pairs = 0, []
    for part, n in sizes:
        pairs += [F.lit(part), F.lit(before)]
        before += n
    return F.element_at(F.create_map(*pairs), F.col("_part")) if pairs else F.lit(0)


def ordinals(df: DataFrame, order: Sequence[Column], name: str = "ordinal") -> DataFrame:
    """``df`` with the place of each row in the order, from 1; rows equal in it in any order."""
    dealt = _dealt(df, order)
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    place = (inside + _offset(dealt, F.lit(1))).cast("long")
    return dealt.withColumn(name, place).drop("_part")


def ranks(df: DataFrame, keys: Sequence[str], descending: bool = False, name: str = "rank") -> DataFrame:
    """``df`` with RANK by the key columns: equal keys share one, and the next is as many later.

    Rows are counted per key before they are ordered, so heavy ties are one row there and
    cannot fall on both sides of a border. Null keys rank as Spark orders them.
    """
    order = [F.col(k).desc() if descending else F.col(k).asc() for k in keys]
    dealt = _dealt(df.groupBy(*keys).agg(F.count("*").alias("_n")), order)
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    smaller = F.coalesce(F.sum("_n").over(inside), F.lit(0)) + _offset(dealt, F.col("_n"))
    places = dealt.select(*[F.col(k).alias(f"_{k}") for k in keys], (smaller + 1).cast("long").alias(name))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(places, same).select(*df.columns, name)
