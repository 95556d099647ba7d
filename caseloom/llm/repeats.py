"""Substring deduplication by hashing lines or paragraphs.

Units are normalised and hashed, the earliest occurrence of each digest is found globally, and
every later one is removed, with its place in the original text retained. Passages that begin or
end inside a unit are located apart from that, by hashes of runs of words.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.llm.common import small_side, written
from caseloom.llm.wordhash import mixed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# What ends a unit.
BREAKS = {"line": "\n", "paragraph": "\n\n"}
UNIT = "id long, key long, start long, end long, digest binary"
STRETCH = "id long, key long, place long, length long, mark long, stretch binary"
RUN = "stretch binary, place long, digest binary"
PASSAGE = "id long, key long, start long, end long, n_words long, later boolean"
#: Odd bases of the two polynomial hashes of a run of words; a digest holds both.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Distinct words whose hashes a task keeps.
KNOWN_WORDS = 500_000


def unit_bounds(text: str, unit: str) -> list[tuple[int, int]]:
    """(start, end) of the units of a text in code points, breaks left out."""
    mark, bounds, start = BREAKS[unit], [], 0
    for found in re.finditer(re.escape(mark), text):
        bounds.append((start, found.start()))
        start = found.end()
    return [*bounds, (start, len(text))]


def _units(unit: str, least_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, k, text in zip(batch.column("id").to_pylist(), batch.column("key").to_pylist(),
                                  batch.column("text")):
                text = text.as_py() or ""
                for start, end in unit_bounds(text, unit):
                    words = text[start:end].lower().split()
                    if len(words) >= least_words:
                        digest = hashlib.blake2b(" ".join(words).encode(), digest_size=16).digest()
                        rows.append((i, k, start, end, digest))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64()] * 4 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)],
                ["id", "key", "start", "end", "digest"])
    return run


def repeated_units(docs: DataFrame, unit: str = "line", least_words: int = 1,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Later occurrences of units: id, key, start and end in the original text, and digest.

    Units compare by their lower-cased words. The earliest occurrence is the one in the
    smallest id (rows without an id last, then by text hash), and there the first. Rows with
    equal id and text count as one document. Every unit that has a word counts, unless the caller
    asks for more words. Null and empty texts have no units.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("key"),
                       F.col(text_col).cast("string").alias("text"))
    units = written(rows.mapInArrow(_units(unit, least_words), UNIT), "units")
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "key", "start")
    first = units.groupBy("digest").agg(F.min(rank).alias("first"), F.count("*").alias("n"))
    many = written(first.where("n > 1").select("digest", "first"), "repeated")
    return (units.join(small_side(many, many.count(), 64), "digest")
            .where(rank != F.col("first")).drop("first").distinct())


def _cut(unit: str, text_col: str, spans_col: str, counted: bool):
    mark = BREAKS[unit]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index(text_col)
            texts = batch.column(text_col).to_pylist()
            words, longest = [0] * len(texts), [0] * len(texts)
            for row, spans in enumerate(batch.column(spans_col).to_pylist()):
                if spans:
                    gone = {s["start"] for s in spans}
                    text, kept, unbroken = texts[row], [], 0
                    for a, b in unit_bounds(text, unit):
                        if a in gone:
                            n = len(text[a:b].split())
                            words[row], unbroken = words[row] + n, unbroken + n
                            longest[row] = max(longest[row], unbroken)
                        else:
                            kept.append(text[a:b])
                            unbroken = unbroken if text[a:b].isspace() or a == b else 0
                    texts[row] = mark.join(kept)
            batch = batch.set_column(at, text_col, pa.array(texts, pa.string()))
            if counted:
                batch = batch.append_column("removed_words", pa.array(words, pa.int64()))
                batch = batch.append_column("longest_removed", pa.array(longest, pa.int64()))
            yield batch
    return run


def deduplicated(docs: DataFrame, unit: str = "line", least_words: int = 1, id_col: str = "doc_id",
                 text_col: str = "text", counted: bool = False) -> DataFrame:
    """All rows and columns of ``docs`` without later occurrences, and the removed ``spans``.

    ``spans`` are (start, end) in the original text, in order, empty where nothing went. The
    breaks of removed units go with them. With ``counted`` also ``removed_words`` and
    ``longest_removed``: the words of all removed units, and of the longest run of removed units
    with no kept word between them. Columns of these names are replaced.
    """
    found = repeated_units(docs, unit, least_words, id_col, text_col)
    spans = found.groupBy(F.col("id").alias("__id"), F.col("key").alias("__key")).agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    spans = written(spans, "spans")
    same = (F.col(id_col).cast("long").eqNullSafe(F.col("__id"))
            & (F.xxhash64(text_col) == F.col("__key")))
    none = F.array().cast(spans.schema["spans"].dataType)
    n_bytes = spans.agg(F.sum(F.size("spans") * 16 + 48)).first()[0] or 0
    added = ("spans", "removed_words", "longest_removed") if counted else ("spans",)
    joined = docs.drop(*added).join(small_side(spans, n_bytes, 1), same, "left").drop("__id", "__key")
    joined = joined.withColumn("spans", F.coalesce("spans", none))
    fields = T.StructType(joined.schema.fields + [T.StructField(c, T.LongType()) for c in added[1:]])
    return joined.mapInArrow(_cut(unit, text_col, "spans", counted), fields)


def _placed_words(text: str, known: dict[str, int]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Hashes of the lower-cased words of a text, and their (start, end) in code points."""
    hashes, bounds = [], []
    for found in re.finditer(r"\S+", text):
        word = found[0].lower()
        if (value := known.get(word)) is None:
            if len(known) >= KNOWN_WORDS:
                known.clear()
            value = known[word] = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest())
        hashes.append(value)
        bounds.append(found.span())
    return np.array(hashes, np.uint64), bounds


def _run_hashes(words: np.ndarray, n: int, base: int) -> np.ndarray:
    """A 64-bit hash of every run of n words, from differences of running sums."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    powers = np.full(len(words) + 1, base, np.uint64)
    powers[0] = 1
    sums = np.append(np.uint64(0), np.cumsum(words * np.cumprod(powers)[:-1], dtype=np.uint64))
    powers[1:] = pow(base, -1, 1 << 64)
    return mixed((sums[n:] - sums[:-n]) * np.cumprod(powers)[: len(words) - n + 1])


def _marks(words: np.ndarray, n: int) -> np.ndarray:
    """The smallest hash of shorter runs inside each run of n words, as signed integers.

    Equal runs have the same mark, and neighbouring runs mostly share one.
    """
    short = (n + 1) // 2
    hashes = _run_hashes(words, short, BASES[0])
    if len(hashes) < n - short + 1:
        return np.empty(0, np.int64)
    return np.lib.stride_tricks.sliding_window_view(hashes, n - short + 1).min(axis=1).view(np.int64)


def _all_marks(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            found = [np.unique(_marks(_placed_words(text.as_py() or "", known)[0], n)) for text in batch.column("text")]
            row = np.repeat(np.arange(len(found)), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(row)), batch.column("key").take(pa.array(row)),
                 pa.array(np.concatenate([np.empty(0, np.int64), *found]))], ["id", "key", "mark"])
    return run


def _marked_stretches(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            rows = []
            for i, k, text, wanted in zip(*(batch.column(c) for c in ("id", "key", "text", "marks"))):
                words = _placed_words(text.as_py() or "", known)[0]
                marks = _marks(words, n)
                starts = np.flatnonzero(np.append(True, marks[1:] != marks[:-1])[: len(marks)])
                ends = np.append(starts[1:], len(marks))
                at = np.isin(marks[starts], np.array(wanted.as_py(), np.int64))
                for a, b in zip(starts[at].tolist(), ends[at].tolist()):
                    digest = hashlib.blake2b(words[a:b + n - 1].tobytes(), digest_size=16).digest()
                    rows.append((i.as_py(), k.as_py(), a, b - a, int(marks[a]), digest))
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64()] * 5 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)],
                                             ["id", "key", "place", "length", "mark", "stretch"])
    return run


def _stretch_runs(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            for text, stretches in zip(batch.column("text"), batch.column("stretches")):
                words = _placed_words(text.as_py() or "", known)[0]
                digests = np.stack([_run_hashes(words, n, base) for base in BASES], axis=1)
                taken = [(s["stretch"], p - s["place"], p) for s in stretches.as_py()
                         for p in range(s["place"], s["place"] + s["length"])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t[0] for t in taken], pa.binary()), pa.array([t[1] for t in taken], pa.int64()),
                     pa.array([digests[t[2]].tobytes() for t in taken], pa.binary())],
                    ["stretch", "place", "digest"])
    return run


def _located(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            rows = []
            for i, k, text, passages in zip(*(batch.column(c) for c in ("id", "key", "text", "passages"))):
                bounds = _placed_words(text.as_py(), known)[1]
                for p in passages.as_py():
                    a, b = p["begin"], p["finish"] + n - 1
                    rows.append((i.as_py(), k.as_py(), bounds[a][0], bounds[b][1], b - a + 1, p["later"]))
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64()] * 5 + [pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)],
                                             ["id", "key", "start", "end", "n_words", "later"])
    return run


def repeated_passages(docs: DataFrame, least_words: int = 51, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Passages that other documents hold too: id, key, start, end, n_words and later.

    A passage is a longest stretch of words of which each lies in a run of ``least_words`` words
    that occurs in another document, wherever lines begin and end. ``later`` tells the passages
    that an earlier document holds from those that are earliest here; the order of documents, and
    words, are those of ``repeated_units``. Rows with equal id and text count as one document,
    whose repeats inside itself are no passages.

    Runs are first compared by their marks, about one for fifteen runs. Stretches of neighbouring
    runs with one mark that occurs in two documents are compared whole, by 128-bit digests; runs
    themselves only where a mark has different stretches, once for each different stretch. So
    copies, also slightly changed ones, add few rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("key"),
                       F.col(text_col).cast("string").alias("text"))
    document = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    ends = F.min("first").alias("first"), F.max("last").alias("last")
    held = F.col("first") != F.col("last")

    def with_text(by_document: DataFrame) -> DataFrame:
        side = by_document.withColumnsRenamed({"id": "__id", "key": "__key"})
        same = F.col("id").eqNullSafe(F.col("__id")) & (F.col("key") == F.col("__key"))
        return rows.join(side, same).drop("__id", "__key")

    marks = written(rows.mapInArrow(_all_marks(least_words), "id long, key long, mark long"), "marks")
    shared = written(marks.groupBy("mark").agg(F.min(document).alias("first"), F.max(document).alias("last"))
                     .where(held).select("mark"), "shared")
    per_doc = (marks.join(small_side(shared, shared.count(), 16), "mark")
               .groupBy("id", "key").agg(F.collect_set("mark").alias("marks")))
    stretches = written(with_text(per_doc).mapInArrow(_marked_stretches(least_words), STRETCH), "stretches")
    at = F.min(F.struct(F.col("id").isNull(), "id", "key", "place")).alias("at")
    kinds = written(stretches.groupBy("mark", "stretch").agg(
        F.min(document).alias("first"), F.max(document).alias("last"), at, F.first("length").alias("length")), "kinds")
    kinds = kinds.join(kinds.groupBy("mark").agg(F.count("*").alias("n")), "mark")
    whole = kinds.where((F.col("n") == 1) & held).select(
        "stretch", "first", F.lit(0).cast("long").alias("begin"), (F.col("length") - 1).alias("finish"))
    several = written(kinds.where("n > 1").select("stretch", "first", "last", "at", "length"), "several")
    taken = several.groupBy(F.col("at.id").alias("id"), F.col("at.key").alias("key")).agg(
        F.collect_list(F.struct("at.place", "length", "stretch")).alias("stretches"))
    runs = written(with_text(taken).mapInArrow(_stretch_runs(least_words), RUN), "runs")
    of_runs = runs.join(several.select("stretch", "first", "last"), "stretch").groupBy("digest").agg(*ends).where(held)
    island = F.col("place") - F.dense_rank().over(Window.partitionBy("stretch", "first").orderBy("place"))
    parts = (runs.join(of_runs.drop("last"), "digest").withColumn("island", island).groupBy("stretch", "first", "island")
             .agg(F.min("place").alias("begin"), F.max("place").alias("finish")).drop("island"))
    parts = written(whole.unionByName(parts), "parts")
    placed = stretches.join(small_side(parts, parts.count(), 80), "stretch").select(
        "id", "key", (F.col("place") + F.col("begin")).alias("begin"),
        (F.col("place") + F.col("finish")).alias("finish"), (document != F.col("first")).alias("later"))
    inside = Window.partitionBy("id", "key", "later").orderBy("begin")
    apart = F.col("begin") - F.lag("finish").over(inside) > least_words
    numbered = placed.withColumn("apart", F.coalesce(apart, F.lit(False)).cast("int"))
    passages = (numbered.withColumn("passage", F.sum("apart").over(inside)).groupBy("id", "key", "later", "passage")
                .agg(F.min("begin").alias("begin"), F.max("finish").alias("finish")).groupBy("id", "key")
                .agg(F.collect_list(F.struct("begin", "finish", "later")).alias("passages")))
    return with_text(passages).mapInArrow(_located(least_words), PASSAGE).distinct()
