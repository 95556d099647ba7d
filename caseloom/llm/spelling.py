"""Spelling variants: pairs of words at edit distance one, and the form each word varies.

Asymmetric q-chunks: the shorter word of a pair (either, if equal) is cut into two disjoint
chunks, and the other gives its positional grams. One edit leaves one chunk whole, at the same
place or shifted by the difference in length, at most one; so near words meet in an equality join
on the chunk, its place and the length, and are verified. A chunk that too many words share is
cut again where the edit may be: the words then meet on all but a smaller part of themselves.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.llm.common import small_side, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

RUNS = "[A-Za-zÀ-ÿ]+"
#: One in so many occurrences of a run in a document is misspelt, see ``word_runs``.
MISSPELT = 97
#: Comparisons that the words of one chunk may cost before the chunk is cut again.
MOST_COMPARED = 20_000
#: Distinct words that a task counts before it passes their counts on.
HELD_WORDS = 200_000
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = str.maketrans(ASCII_UPPER, ASCII_UPPER.lower())


def misspelt(name: bytes, run: str) -> str:
    """The run, without one code point if the checksum of the document's name and it says so."""
    h = zlib.crc32(run.encode(), zlib.crc32(name))
    if h % MISSPELT:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _runs(least_length: int):
    find = re.compile(RUNS).finditer

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter[str] = Counter()
        for batch in batches:
            for i, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                name = f"{'null' if i is None else i}:".encode()
                runs = Counter(m[0] for m in find((text.as_py() or "").translate(_LOWER)))
                for word, n in runs.items():
                    word = misspelt(name, word)
                    if len(word) >= least_length:
                        sums[word] += n
                if len(sums) >= HELD_WORDS:
                    yield _counted(sums)
                    sums.clear()
        yield _counted(sums)
    return run


def _counted(sums: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.int64())], ["word", "n"])


def word_runs(docs: DataFrame, least_length: int = 5, least_count: int = 3, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """(word, n): runs of Latin letters in all texts, A-Z lower-cased, and how often they occur.

    The checksum of a document's id and a run decides whether that document misspells it by
    leaving out a code point. Only words of ``least_length`` code points and ``least_count``
    occurrences are returned. Null texts have no runs; rows without an id are named ``null``;
    repeated rows count again. Tasks count before they shuffle.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return (rows.mapInArrow(_runs(least_length), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count))


def _key(word: Column, length: Column, low: Column, high: Column, shift: Column) -> Column:
    """What a word shares with words of ``length`` that differ from it in [low, high) only.

    ``shift`` is how much longer the word is, 0 or 1.
    """
    head = F.substring(word, F.lit(1), low)
    tail = F.substring(word, high + shift + 1, F.length(word))
    return F.xxhash64(length, low, high, head, tail)


def chunk_rows(words: DataFrame) -> DataFrame:
    """(word, n, shift, length, low, high, key): the two chunks of each word, and the grams at
    the places of the chunks of words that are one code point shorter.

    The chunk that stays whole is what lies outside [low, high). Words of equal length meet in
    the rows of shift 0, which are chunks and grams at once.
    """
    half = F.floor(F.col("length") / 2).cast("int")
    return (words.select("word", "n", F.explode(F.array(F.lit(0), F.lit(1))).alias("shift"))
            .withColumn("length", (F.length("word") - F.col("shift")).cast("int"))
            .where("length > 0")
            .withColumn("part", F.explode(F.array(
                F.struct(F.lit(0).alias("low"), half.alias("high")),
                F.struct(half.alias("low"), F.col("length").alias("high")))))
            .select("word", "n", "shift", "length", "part.low", "part.high"))


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("key", _key(*(F.col(c) for c in ("word", "length", "low", "high", "shift"))))


def near_pairs(words: DataFrame, most_compared: int = MOST_COMPARED) -> DataFrame:
    """(a, b, n_a, n_b): all pairs of distinct words (word, n) at edit distance one, each once.

    An edit is one inserted, deleted or replaced code point. ``a`` is the shorter word, the
    smaller one if both are as long. Rows of a chunk that would cost more than
    ``most_compared`` comparisons are cut again until the part that may differ is one code
    point, where an alphabet bounds them; no pair is left out.
    """
    rows = _keyed(chunk_rows(words))
    ready = None
    while True:
        rows = written(rows, "chunks")
        sizes = rows.groupBy("key", (F.col("high") - F.col("low")).alias("open")).agg(
            F.sum(1 - F.col("shift")).alias("short"), F.sum("shift").alias("long"))
        cost = F.col("short") * (F.col("short") - 1) / 2 + F.col("short") * F.col("long")
        # Keys of one word need no comparison, the others one row each.
        shared = written(sizes.where("short > 0 and short + long > 1")
                         .select("key", ((cost > most_compared) & (F.col("open") > 1)).alias("cut")), "shared")
        n_hot, n_shared = shared.agg(F.count_if("cut"), F.count("*")).first()
        met = rows.join(small_side(shared, n_shared, 24), "key")
        fine = met.where("not cut").drop("cut")
        ready = fine if ready is None else ready.unionByName(fine)
        if not n_hot:
            break
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        rows = _keyed(met.where("cut").drop("cut", "key").withColumn("part", F.explode(F.array(
            F.struct("low", middle.alias("high")), F.struct(middle.alias("low"), "high"))))
            .select("word", "n", "shift", "length", "part.low", "part.high"))
    ready = written(ready, "ready")
    a, b = (ready.select("key", "shift", *[F.col(c).alias(f"{c}_{k}") for c in ("word", "n")]) for k in "ab")
    a, b = a.where("shift = 0").drop("shift").withColumnsRenamed({"word_a": "a"}), b.withColumnsRenamed({"word_b": "b"})
    verified = (F.col("shift") == 1) | (F.col("a") < F.col("b"))
    return (a.join(b, (a["key"] == b["key"]) & verified & (F.levenshtein("a", "b", 1) == 1))
            .groupBy("a", "b").agg(F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b")))


def spelling_forms(words: DataFrame, pairs: DataFrame, times: int = 2) -> DataFrame:
    """(word, n, n_near, form, form_n): each word's most frequent near word, if ``times`` as frequent.

    Ties go to the smallest in code point order. A word without near words has ``n_near`` 0.
    """
    both = pairs.select(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("near"),
                        F.col("n_b").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("n_b").alias("n"), F.col("a").alias("near"),
                     F.col("n_a").alias("near_n")))
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("down"), "near")).alias("best"))
    joined = words.join(best, "word", "left")
    frequent = -F.col("best.down") >= times * F.col("n")
    return joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(frequent, F.col("best.near")).alias("form"), F.when(frequent, -F.col("best.down")).alias("form_n"))


def rooted(forms: DataFrame) -> DataFrame:
    """``forms`` with ``root``: where a word's forms lead in the end, itself without a form.

    Frequencies rise along forms, so there are no rings. Each round doubles how far a word
    sees, so rounds are few: the logarithm of the longest chain.
    """
    steps = written(forms.where("form is not null").select("word", F.col("form").alias("root")), "steps")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = written(steps.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "steps")
        steps = joined.select("word", "root")
        if joined.where("moved").isEmpty():
            break
    return forms.join(steps, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variant_groups(docs: DataFrame, least_length: int = 5, least_count: int = 3, times: int = 2,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n, n_near, form, form_n, root) for all words of ``docs``; see ``word_runs``.

    An empty table gives no words.
    """
    words = written(word_runs(docs, least_length, least_count, id_col, text_col), "words")
    return rooted(written(spelling_forms(words, near_pairs(words)), "forms"))
