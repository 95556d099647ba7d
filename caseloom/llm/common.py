"""Helpers shared by the operators: shared tables, checked broadcasts, ordered blocks, words."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows times estimated row bytes that may be broadcast; beyond it a side is joined by shuffle.
BROADCAST_BYTES = 64 * 1024 * 1024
#: Quantile ranges of an ordering key before they are divided further.
COARSE_RANGES = 128


def shared_root(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir``, else the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/llm-{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor costs tasks of later stages only, and every reader
    sees the same rows.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(df: DataFrame) -> None:
    """Delete a table made by ``written`` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(location, True)


def small_side(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` marked for broadcast when its counted size is within the bound, else unmarked."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, also where a lambda uses it repeatedly."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character kept; pure ASCII takes the faster built-in path."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (F.when(F.octet_length(text) == F.length(text), F.lower(text))
            .otherwise(F.translate(text, upper, upper.lower())))


def _index_of(key: Column, cuts: Sequence[int], low: int = 0) -> Column:
    """Number of cuts at or below the key, as a balanced tree of comparisons."""
    if not cuts:
        return F.lit(low)
    middle = len(cuts) // 2
    return (F.when(key < cuts[middle], _index_of(key, cuts[:middle], low))
            .otherwise(_index_of(key, cuts[middle + 1:], low + middle + 1)))


def order_blocks(df: DataFrame, key: str, rows_per_block: int, tie: Column) -> tuple[Column, int]:
    """An expression that numbers blocks in ascending order of an integer key, and their count.

    Quantiles of the key give coarse ranges, each divided evenly into cells of about
    ``rows_per_block`` rows. Blocks follow the key's order, so running values need only a
    window inside a block and one total per block. Rows without a key come first, dealt to
    blocks by the order of ``tie`` (a 64-bit hash).
    """
    at = [i / COARSE_RANGES for i in range(1, COARSE_RANGES)]
    found = df.select(
        F.count("*").alias("n"), F.count(key).alias("keyed"), F.min(key).alias("low"),
        F.max(key).alias("high"), F.percentile_approx(key, at, 10_000).alias("cuts")).first()
    cells = max(1, -(-found["keyed"] // (COARSE_RANGES * rows_per_block)))
    loose = max(1, -(-(found["n"] - found["keyed"]) // rows_per_block))
    spread = (tie.cast("double") / F.lit(2.0**64) + F.lit(0.5)) * F.lit(loose)
    unkeyed = F.least(F.floor(spread), F.lit(loose - 1)).cast("int")
    if not found["keyed"]:
        return unkeyed, loose
    cuts = sorted({int(c) for c in found["cuts"] if c > found["low"]})
    edges = [int(found["low"]), *cuts, int(found["high"]) + 1]
    number = F.col(key).cast("long")
    if cells == 1:
        block = _index_of(number, cuts)
    else:
        coarse = _index_of(number, cuts)
        low = F.element_at(F.lit(edges[:-1]), coarse + 1)
        width = F.element_at(F.lit([float(b - a) for a, b in zip(edges, edges[1:])]), coarse + 1)
        cell = F.floor((number - low).cast("double") * F.lit(float(cells)) / width)
        block = coarse * cells + F.least(cell, F.lit(cells - 1)).cast("int")
    blocks = (len(cuts) + 1) * cells + loose
    return F.when(F.col(key).isNull(), unkeyed).otherwise(block + loose).cast("int"), blocks
