"""Threshold-scaled document sketches (a fixed fraction of all shingle hashes).

A text's sketch holds every shingle hash in the lowest ``1 / SCALE`` of the hash range, so
sketches of texts of any length stay comparable: their overlap estimates likeness and, between
very unequal texts, containment, and the sketch of a union is the union of sketches. Built-in
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.llm.common import let, order_blocks, small_side

SHINGLE_WORDS = 5
SCALE = 4
WORD = r"[^\x20\x09-\x0D]+"
ROWS_PER_BLOCK = 500
_LOWEST = -(2**63)


def shingle_hashes(text: Column, n: int = SHINGLE_WORDS) -> Column:
    """64-bit hashes of all runs of ``n`` lower-cased words, in order.

    Words lie between white space. A text of fewer words is one shingle; one without words,
    or null, has none.
    """
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    return let(F.coalesce(words, F.array().cast("array<string>")), lambda w: _hashes(w, n))


def _hashes(words: Column, n: int) -> Column:
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(1)))
    each = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, n)))
    return F.when(F.size(words) > 0, each).otherwise(F.array().cast("array<bigint>"))


def sketch(text: Column, n: int = SHINGLE_WORDS, scale: int = SCALE) -> Column:
    """Sorted distinct shingle hashes below the threshold.

    If none is below, the smallest hash stands alone, so that short texts keep a sketch. That
    stays mergeable: see ``merged_sketch``.
    """
    return let(shingle_hashes(text, n), lambda hashes: _scaled(hashes, scale))


def _scaled(hashes: Column, scale: int) -> Column:
    limit = _LOWEST + 2**64 // scale
    low = F.array_sort(F.array_distinct(F.filter(hashes, lambda h: h < F.lit(limit))))
    least = F.filter(F.array(F.array_min(hashes)), lambda h: h.isNotNull())
    return let(low, lambda kept: F.when(F.size(kept) > 0, kept).otherwise(least))


def merged_sketch(a: Column, b: Column, scale: int = SCALE) -> Column:
    """Sketch of the union of two shingle sets, from their sketches alone."""
    return let(F.array_union(a, b), lambda hashes: _scaled(hashes, scale))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two texts from their sketches; 1 for two empty ones."""
    def of(shared: Column) -> Column:
        either = F.size(a) + F.size(b) - shared
        return F.when(either == 0, F.lit(1.0)).otherwise(shared / either)
    return let(F.size(F.array_intersect(a, b)), of)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` holds; 1 if ``a`` has none."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def fingerprint(sketched: Column) -> Column:
    """The sketch as text: 16 hexadecimal digits for each hash."""
    return F.array_join(F.transform(sketched, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def with_next(docs: DataFrame, carried: list[str], tie_cols: list[str], id_col: str = "doc_id",
              rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """``docs`` with ``next_<column>`` of the next row in descending order of the id.

    The last row is followed by the first, a single row by itself. Rows without an id come
    last, rows of one id follow each other by a hash of ``tie_cols``. The rows are
    dealt to ordered blocks; each block also gets the first row of the block that follows it,
    so that no window spans more than a block.
    """
    tie = F.xxhash64(*tie_cols)
    block, n_blocks = order_blocks(docs, id_col, rows_per_block, tie)
    rows = docs.select("*", tie.alias("__tie"), block.alias("__block"))
    place = F.struct(F.col(id_col).alias("id"), F.bitwise_not("__tie").alias("tie"))
    heads = rows.groupBy("__block").agg(F.max(place).alias("__head"))
    in_order = Window.orderBy(F.col("__block"))  # one row per block
    whole = Window.partitionBy()
    reader = F.coalesce(F.lead("__block").over(in_order), F.min("__block").over(whole))
    heads = heads.select("__head", F.col("__block").alias("__of"), reader.alias("__reader"))
    same = ((F.col("__block") == F.col("__of")) & F.col(id_col).eqNullSafe(F.col("__head.id"))
            & (F.bitwise_not("__tie") == F.col("__head.tie")))
    guests = (rows.join(small_side(heads, n_blocks, 64), same)
              .dropDuplicates(["__of"])
              .withColumn("__block", F.col("__reader")).select(*rows.columns))
    both = rows.withColumn("__guest", F.lit(0)).unionByName(guests.withColumn("__guest", F.lit(1)))
    order = Window.partitionBy("__block").orderBy("__guest", F.col(id_col).desc_nulls_last(), "__tie")
    following = [F.lead(c).over(order).alias(f"next_{c}") for c in carried]
    return (both.select("*", *following).where(F.col("__guest") == 0)
            .drop("__guest", "__tie", "__block"))


def edited(text: Column, following: Column) -> Column:
    """The text with its last third of code points replaced by as many first ones of another."""
    cut = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - cut), F.substring(following, F.lit(1), cut))
