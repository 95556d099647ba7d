"""Mixing sources to target weights by repeating and sampling whole documents.

Sizes are added up per source, weights become targets and targets become repetition rates. A
document is taken floor(rate) times, and once more when its hash-seeded coin, which falls
with the fraction of the rate, says so.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.llm.common import small_side, written

# Word separators of size counts: space and the control characters 9 to 13.
WORDS = r"[^\x20\x09-\x0D]+"
#: Rows of repeated ids that one part numbers.
PART_ROWS = 4_096


def word_count(text: Column) -> Column:
    """Number of words of a text as a long; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def source_rates(docs: DataFrame, size: str, source: str = "source",
                 weights: Sequence[int] = (3, 1, 2), share: tuple[int, int] = (3, 2),
                 most: int = 2) -> DataFrame:
    """One row per source: ``source_size``, ``target`` and ``rate`` (target by size).

    Sources in code-point order, null last, weigh ``weights`` in turn and share
    ``share[0] / share[1]`` of all sizes. A target stops at ``most`` times its source's size
    and the excess is shared again by weight until none is above. That end is a common level:
    the sources with the smallest cap per weight stop at their caps, the rest get level times
    weight, so one pass over the sources ordered by cap per weight finds it. Sources of size
    0 have target 0 and rate 0. The windows hold one row per source.
    """
    sums = docs.groupBy(F.col(source).alias("__source")).agg(F.sum(size).alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("__source").asc_nulls_last())) - 1)
    weight = F.element_at(F.lit(list(weights)), (turn % len(weights) + 1).cast("int"))
    sums = sums.withColumn("weight", weight.cast("long"))
    by_cap = Window.orderBy((F.col("source_size") / F.col("weight")),
                            F.col("__source").asc_nulls_last())
    ahead = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    here_on = by_cap.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    # Level of the weights when exactly the sources ahead have stopped, as a fraction of longs.
    left = (F.sum("source_size").over(whole) * share[0]
            - F.coalesce(F.sum("source_size").over(ahead), F.lit(0)) * (most * share[1]))
    per = F.sum("weight").over(here_on) * share[1]
    levels = (sums.withColumn("left", left).withColumn("per", per)
              .withColumn("stops", F.col("left") * F.col("weight")
                          >= F.col("source_size") * most * F.col("per")))
    free = F.when(~F.col("stops"), F.struct("left", "per"))
    first_free = F.first(free, ignorenulls=True).over(
        by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    levels = levels.withColumn("level", first_free)
    stopped = F.col("stops") | F.col("level").isNull()
    target = (F.when(stopped, (F.col("source_size") * most).cast("double"))
              .otherwise(F.col("level.left") * F.col("weight") / F.col("level.per")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return (levels.withColumn("target", target).withColumn("rate", rate)
            .select("__source", "source_size", "target", "rate"))


#: Columns that ``mixed_counts`` adds.
ADDED = ("size", "source_size", "target", "copies")


def coin(name: Column, seed: str) -> Column:
    """A number in [0, 1) fixed by the seed and a name, the id where it is unique (null too)."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(name.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") / F.lit(float(16**12))


def _numbered(rows: DataFrame, id_col: str, n_rows: int) -> DataFrame:
    """``rows`` and the ``__name`` of each: its id, a hash of the row, and a number among equal rows.

    Equal rows are dealt to parts by a hash of their place and numbered there; counts of the
    parts before are added, so no window holds all copies of a row. They are equal, so it does
    not matter which of them gets which number.
    """
    hashed = [c for c, kind in rows.dtypes if "map<" not in kind and "variant" not in kind]
    same = F.xxhash64(*hashed, *[F.col(c).isNull() for c in hashed])
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(-(-n_rows // PART_ROWS)))
    dealt = written(rows.withColumn("__row", same).withColumn("__part", part), "dealt")
    before = Window.partitionBy("__row").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy("__row", "__part").agg(F.count("*").alias("__n")).select(
        "__row", "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    here = F.row_number().over(Window.partitionBy("__row", "__part").orderBy("__row"))
    name = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), "__row",
                       F.col("__before") + F.col("__here"))
    return (dealt.withColumn("__here", here).join(parts, ["__row", "__part"])
            .select(*rows.columns, name.alias("__name")))


def _named(rows: DataFrame, id_col: str) -> DataFrame:
    """``rows`` and the ``__name`` their coin goes by: a unique id itself, else see ``_numbered``."""
    name = F.col(id_col).cast("string").alias("__name")
    ids = written(rows.groupBy(F.col(id_col).alias("__id")).agg(F.count("*").alias("__n"))
                  .where("__n > 1"), "repeated-ids")
    n_ids, n_rows = ids.agg(F.count("*"), F.sum("__n")).first()
    if not n_ids:
        return rows.select("*", name)
    again, same = small_side(ids, n_ids, 48), F.col(id_col).eqNullSafe(F.col("__id"))
    return (rows.join(again, same, "left_anti").select("*", name)
            .unionByName(_numbered(rows.join(again, same, "left_semi"), id_col, n_rows)))


def mixed_counts(docs: DataFrame, size: Column, id_col: str = "doc_id", source: str = "source",
                 seed: str = "mix", weights: Sequence[int] = (3, 1, 2),
                 share: tuple[int, int] = (3, 2), most: int = 2) -> DataFrame:
    """All rows and columns of ``docs`` with ``size``, ``source_size``, ``target``, ``copies``.

    ``copies`` is how often the mix takes the document, ``most`` times at the most. Every row
    tosses a coin of its own, also where ids are missing or repeated, and reruns agree. Null
    texts have size 0 and are repeated like the rest of their source. The sources are joined by
    broadcast only where their counted number allows it.
    """
    kept = [c for c in docs.columns if c not in ADDED]
    sized = docs.select(*kept, size.alias("size"))
    rates = source_rates(sized, "size", source, weights, share, most)
    n_sources = docs.select(F.approx_count_distinct(source)).first()[0] * 2 + 1
    whole = F.floor("rate")
    copies = whole + (coin(F.col("__name"), seed) < F.col("rate") - whole).cast("long")
    return (_named(sized, id_col).join(small_side(rates, n_sources, 200),
                                       F.col(source).eqNullSafe(F.col("__source")), "left")
            .withColumn("copies", copies.cast("int"))
            .select(*kept, "size", "source_size", "target", "copies"))


def mixed(docs: DataFrame, size: Column, **settings) -> DataFrame:
    """The mix itself: every document as often as ``mixed_counts`` takes it, same columns and values."""
    own = {c: f"__own_{c}" for c in ADDED if c in docs.columns}
    counted = mixed_counts(docs.withColumnsRenamed(own), size, **settings)
    taken = counted.where(F.col("copies") > 0)
    repeated = taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])
