"""Contiguous shards of nearly equal bytes, cut on global prefix sums.

Rows are ordered by their id and divided into ordered blocks. One total per block gives each
block its offset; a running sum inside the block gives each row its place in the whole. The
shard is where the middle of the row falls when the bytes are cut at equal targets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.llm.common import order_blocks, small_side

ROWS_PER_BLOCK = 4_000


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text and its line end; a null text has only the line end."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def text_checksum(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; a null text counts as empty."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def byte_shards(docs: DataFrame, n_shards: int, size: Column, id_col: str = "doc_id",
                rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """All rows and columns of ``docs`` with ``shard`` (int) and ``slot`` (long, from 0).

    ``size`` is the row's positive byte size. Shards follow the order of the id (null ids
    first; rows of one id by a hash of all their columns, so that repeated rows, which are
    kept, may swap places only with their equals). Sizes of shards differ from the target by
    at most one row at either end. Fewer rows than shards leave shards empty; an empty table
    stays empty. Columns of ``docs`` named ``shard`` or ``slot`` are replaced.
    """
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    docs = docs.select(*kept)
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in kept])
    block, n_blocks = order_blocks(docs, id_col, rows_per_block, tie)
    rows = docs.select("*", size.alias("__size"), tie.alias("__tie"), block.alias("__block"))
    totals = rows.groupBy("__block").agg(F.sum("__size").alias("bytes"), F.count("*").alias("n"))
    ahead = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    offsets = totals.select(
        "__block", F.coalesce(F.sum("bytes").over(ahead), F.lit(0)).alias("__bytes_ahead"),
        F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("__rows_ahead"),
        F.sum("bytes").over(whole).alias("__bytes_all"))
    inside = Window.partitionBy("__block").orderBy(F.col(id_col).asc_nulls_first(), "__tie")
    start = F.col("__bytes_ahead") + F.sum("__size").over(
        inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__size")
    placed = (rows.join(small_side(offsets, n_blocks, 40), "__block")
              .withColumn("__start", start)
              .withColumn("__row", F.col("__rows_ahead") + F.row_number().over(inside) - 1)
              .withColumn("shard", F.least(F.lit(n_shards - 1), F.expr(
                  f"((2 * __start + __size) * {n_shards}L) div (2 * __bytes_all)")).cast("int")))
    first = placed.groupBy("shard").agg(F.min("__row").alias("__first"))
    slot = (F.col("__row") - F.col("__first")).cast("long").alias("slot")
    return placed.join(small_side(first, n_shards, 16), "shard").select(*kept, "shard", slot)
