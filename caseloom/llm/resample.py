"""Importance resampling towards a target corpus on hashed n-grams.

Separators collapse to single spaces, then one overlapped regular expression scan, held to word
boundaries by lookarounds, gives every run of n words as a span, whose bytes are hashed by CRC-32
into buckets. Bucket counts of the raw and the target corpus give each bucket a gain in integer
thousandths, a document's weight is the sum of its gains, and the highest weights with
hash-seeded Gumbel noise are drawn, which is sampling without replacement in proportion to
the likelihood ratio.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.llm.common import order_blocks, small_side, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# What parts words, in the UTF-8 bytes of a text whose A-Z are lower-cased.
SEPARATORS = rb"[^0-9a-z\x80-\xFF]+"
#: Rows that share a window when the drawn ones are ranked.
ROWS_PER_BLOCK = 4_000
#: Bytes of a long text that are scanned at a time.
SLICE_BYTES = 4_000_000


def gram_pattern(n: int) -> regex.Pattern:
    """A run of n words between blanks; overlapped scans find one at every word."""
    return regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1))


def collapsed(text: str) -> bytes:
    """The words of a text, lower-cased and parted by single spaces."""
    return re.sub(SEPARATORS, b" ", text.encode().lower()).strip(b" ")


def gram_buckets(words: bytes, patterns: list[regex.Pattern], n_buckets: int) -> np.ndarray:
    """The buckets of all n-grams of collapsed words, repeats kept."""
    found = [zlib.crc32(span[0]) for pattern in patterns for span in pattern.finditer(words, overlapped=True)]
    return np.array(found, np.uint32) % np.uint32(n_buckets)


def _slices(words: bytes, longest: int) -> Iterator[bytes]:
    """Collapsed words in parts of bounded size; a part ends with the words its last runs need."""
    start = 0
    while len(words) - start > SLICE_BYTES:
        cut = end = words.find(b" ", start + SLICE_BYTES)
        for _ in range(longest - 1):
            end = words.find(b" ", end + 1) if end >= 0 else -1
        if cut < 0 or end < 0:
            break
        yield words[start:end]
        start = cut + 1
    yield words[start:]


def _hashed(sizes: tuple[int, ...], n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [gram_pattern(n) for n in sizes]
        for batch in batches:
            counts, features, buckets = [], [], []
            for text in batch.column("text"):
                words = collapsed(text.as_py() or "")
                counts.append(words.count(b" ") + 1 if words else 0)
                # Each length is cut by itself, so that no run is found in two parts.
                found = np.concatenate([gram_buckets(part, [pattern], n_buckets)
                                        for n, pattern in zip(sizes, patterns) for part in _slices(words, n)])
                features.append(len(found))
                buckets.append(found.tobytes())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in batch.schema.names if c != "text"),
                 pa.array(counts, pa.int64()), pa.array(features, pa.int64()), pa.array(buckets, pa.binary())],
                [*(c for c in batch.schema.names if c != "text"), "n_words", "n_features", "buckets"])
    return run


def _tallied(n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(n_buckets, np.int64)
        for batch in batches:
            for raw in batch.column("buckets"):
                sums += np.bincount(np.frombuffer(raw.as_buffer(), np.uint32), minlength=n_buckets)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(sums[at], pa.int64())], ["bucket", "n"])
    return run


def _weighed(gains: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [int(gains[np.frombuffer(raw.as_buffer(), np.uint32)].sum()) for raw in batch.column("buckets")]
            at = batch.schema.names.index("buckets")
            yield batch.remove_column(at).append_column("weight", pa.array(sums, pa.int64()))
    return run


def hashed_features(docs: DataFrame, sizes: tuple[int, ...], n_buckets: int, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_features`` and ``buckets`` (32-bit integers) for its text."""
    kept = [c for c in docs.columns if c not in (text_col, "n_words", "n_features", "buckets")]
    rows = docs.select(*kept, F.col(text_col).cast("string").alias("text"))
    fields = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in kept)
    return rows.mapInArrow(_hashed(sizes, n_buckets),
                           fields + "n_words long, n_features long, buckets binary")


def bucket_counts(features: DataFrame, n_buckets: int) -> DataFrame:
    """(bucket, n) over all rows; every task sends at most one row per bucket."""
    return (features.select("buckets").mapInArrow(_tallied(n_buckets), "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def bucket_gains(raw: DataFrame, target: DataFrame, n_buckets: int) -> DataFrame:
    """(bucket, gain): thousandths of the log ratio of smoothed target and raw frequencies."""
    every = raw.sparkSession.range(n_buckets).select(F.col("id").alias("bucket"))
    both = (every.join(raw.withColumnRenamed("n", "s"), "bucket", "left")
            .join(target.withColumnRenamed("n", "t"), "bucket", "left").fillna(0, ["s", "t"]))
    whole = Window.partitionBy()  # one row per bucket
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    all_s, all_t = (F.sum(c).over(whole).cast("double") for c in ("s", "t"))
    ratio = ((t + 1) * (all_s + n_buckets)) / ((s + 1) * (all_t + n_buckets))
    return both.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).alias("gain"))


def noise(id_text: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, fixed by the seed and the id (a missing id counts as ``null``)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(id_text.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def weights(docs: DataFrame, target: DataFrame, sizes: tuple[int, ...] = (1, 2), n_buckets: int = 10_000,
            text_col: str = "text", target_text: str = "text") -> DataFrame:
    """All columns of ``docs`` but its text, with ``n_words``, ``n_features`` and ``weight``.

    The buckets of every text are stored once and read twice. The gains, one integer per
    bucket, are the only thing that reaches the driver. Null and empty texts weigh 0.
    """
    features = written(hashed_features(docs, sizes, n_buckets, text_col), "features")
    wanted = hashed_features(target.select(F.col(target_text).alias("text")), sizes, n_buckets)
    table = bucket_gains(bucket_counts(features, n_buckets), bucket_counts(wanted, n_buckets), n_buckets).collect()
    gains = np.zeros(n_buckets, np.int64)
    for row in table:
        gains[row["bucket"]] = row["gain"]
    kept = [f for f in features.schema.fields if f.name not in ("buckets", "weight")]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return features.select(*[f.name for f in kept], "buckets").mapInArrow(_weighed(gains), fields + "weight long")


def resampled(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, seed: int = 2024,
              sizes: tuple[int, ...] = (1, 2), n_buckets: int = 10_000, id_col: str = "doc_id",
              text_col: str = "text", rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """All rows of ``docs`` without its text, with ``n_words``, ``n_features``, ``weight``, ``score``, ``rank``.

    Of the rows with at least ``least_words`` words, ``percent`` in a hundred (rounded down)
    with the highest scores are drawn and get their rank; ties go to the smaller id (null ids
    last, rows of one id by a hash of the row, so repeated rows may swap). An empty target
    gives all buckets the ratio of their smoothed raw counts. Columns named like the new ones
    are replaced. Scores are ranked in ordered blocks: only blocks that hold drawn rows are
    sorted, and their offsets come from one count per block.
    """
    added = ("n_words", "n_features", "weight", "score", "rank")
    docs = docs.select(*[c for c in docs.columns if c not in added])
    weighed = weights(docs, target, sizes, n_buckets, text_col)
    kept = [c for c in weighed.columns if c not in added]
    hashed = [c for c, kind in weighed.dtypes if "map<" not in kind and "variant" not in kind]
    scored = written(weighed.withColumn("score", F.col("weight") + noise(F.col(id_col), seed))
                     .withColumn("__down", -F.col("score"))
                     .withColumn("__tie", F.xxhash64(*[F.col(f"`{c}`") for c in hashed])), "scored")
    able = scored.where(F.col("n_words") >= least_words)
    block, n_blocks = order_blocks(able, "__down", rows_per_block, F.col("__tie"))
    scored = scored.withColumn("__block", F.when(F.col("n_words") >= least_words, block))
    totals = scored.where("__block is not null").groupBy("__block").agg(F.count("*").alias("n"))
    ahead = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "__block", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("__ahead"),
        F.expr(f"sum(n) over () * {percent} div 100").alias("__drawn"))
    placed = scored.join(small_side(offsets, n_blocks, 32), "__block", "left")
    inside = Window.partitionBy("__block").orderBy("__down", F.col(id_col).asc_nulls_last(), "__tie")
    rank = F.col("__ahead") + F.row_number().over(inside)
    may_be_drawn = F.coalesce(F.col("__ahead") < F.col("__drawn"), F.lit(False))
    some = placed.where(may_be_drawn).withColumn("__rank", rank)
    final = [*kept, "n_words", "n_features", "weight", "score"]
    return (some.select(*final, F.when(F.col("__rank") <= F.col("__drawn"), F.col("__rank")).alias("rank"))
            .unionByName(placed.where(~may_be_drawn).select(*final, F.lit(None).cast("long").alias("rank"))))
