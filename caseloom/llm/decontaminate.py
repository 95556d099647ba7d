"""Benchmark decontamination with a hash set of normalised item n-grams.

Every window of consecutive words of a document is hashed and looked up in the set of item
windows; a hit is verified word by word. Hits become word spans, with which documents are
judged, or removed, or freed of the hit words. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.llm.common import BROADCAST_BYTES, ascii_lower, let, small_side, written

WINDOW_WORDS = 10
# Words are runs of characters outside these ASCII ranges (fixed values).
LOWER_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased (A-Z only) words of a text; none for a null or empty one."""
    found = F.regexp_extract_all(ascii_lower(text), F.lit(LOWER_WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def item_windows(benchmark: DataFrame, n: int = WINDOW_WORDS, item_col: str = "item_id",
                 text_col: str = "text") -> DataFrame:
    """Distinct windows of all items: item, length, hash and the words joined by blanks.

    An item with fewer words than ``n`` is one window; one without words has none.
    """
    items = benchmark.select(F.col(item_col).alias("item"), words(F.col(text_col)).alias("w"))
    items = items.where(F.size("w") > 0).withColumn("length", F.least(F.size("w"), F.lit(n)))
    starts = F.explode(F.sequence(F.lit(1), F.size("w") - F.col("length") + 1))
    gram = F.slice("w", F.col("start"), F.col("length"))
    return (items.withColumn("start", starts)
            .select("item", "length", F.xxhash64(gram).alias("hash"),
                    F.array_join(gram, " ").alias("gram")).distinct())


def _union_length(spans: Column) -> Column:
    """Words covered by sorted (start, end) spans."""
    def step(seen, span):
        new = span["end"] - F.greatest(span["start"], seen["end"])
        return F.struct((seen["hit"] + F.greatest(new, F.lit(0))).alias("hit"),
                        F.greatest(seen["end"], span["end"]).alias("end"))
    start = F.struct(F.lit(0).alias("hit"), F.lit(0).alias("end"))
    return F.aggregate(spans, start, step, lambda seen: seen["hit"]).cast("long")


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW_WORDS,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: id, ``text_hash``, ``n_words``, ``n_hit``, ``items``, ``spans``.

    ``spans`` are the (start, end) word ranges of occurring windows in order, ``n_hit`` counts
    the words inside any of them, ``items`` are the distinct ids, as sorted strings, of items
    with an occurring window; items without an id mark words but are not listed. Null and
    empty texts have no words. Repeated rows each get a row. An empty benchmark hits nothing.

    The set of windows is broadcast while its counted size stays in the bound; beyond it the
    hashes of the documents' windows are shuffled to the set without any text, and words are
    brought back for the texts that have one of its hashes.
    """
    grams = item_windows(benchmark, n)
    known = grams.groupBy("length").agg(F.count("*").alias("n"), F.sum(
        F.octet_length("gram") + F.lit(48)).alias("bytes")).orderBy("length").collect()  # n rows at most
    lengths = [row["length"] for row in known]
    fits = sum(row["bytes"] for row in known) <= BROADCAST_BYTES
    empty = F.array().cast("array<bigint>")

    def hashes(length: int) -> Column:
        def each(w: Column) -> Column:
            at = F.sequence(F.lit(1), F.size(w) - length + 1)
            return F.when(F.size(w) >= length, F.transform(
                at, lambda i: F.xxhash64(F.slice(w, i, length)))).otherwise(empty)
        return let(F.col("words"), each)

    # Place 0 holds a null that no window equals: it keeps the documents without hits.
    marked = F.concat(F.array(F.lit(None).cast("bigint")), *[hashes(k) for k in lengths])
    scanned = (docs.select(F.col(id_col), F.xxhash64(text_col).alias("text_hash"),
                           words(F.col(text_col)).alias("words"))
               .select(id_col, "text_hash", "words", F.posexplode(marked).alias("place", "hash")))
    offset = F.lit(1)  # of the first window of each length in the array
    begins = F.lit(None).cast("int")
    for length in lengths:
        begins = F.when(F.col("length") == length, offset).otherwise(begins)
        offset = offset + F.greatest(F.size("words") - length + 1, F.lit(0))
    start = F.col("place") - begins
    same_words = F.array_join(F.slice("words", F.greatest(start + 1, F.lit(1)), F.col("length")),
                              " ") == F.col("gram")
    if not fits:
        return _shuffled(docs, scanned, grams, begins, same_words, id_col, text_col)
    hit = scanned.join(F.broadcast(grams), (scanned["hash"] == grams["hash"]) & same_words, "left")
    hit = hit.where((F.col("place") == 0) | F.col("gram").isNotNull())
    span = F.when(F.col("place") > 0, F.struct(
        start.cast("int").alias("start"), (start + F.col("length")).cast("int").alias("end")))
    per_doc = (hit.select(id_col, "text_hash", F.size("words").cast("long").alias("n_words"),
                          (F.col("place") == 0).cast("int").alias("row"), span.alias("span"),
                          F.col("item").cast("string").alias("item"))
               .groupBy(id_col, "text_hash")
               .agg(F.max("n_words").alias("n_words"), F.sum("row").alias("rows"),
                    F.array_sort(F.collect_set("span")).alias("spans"),
                    F.array_sort(F.collect_set("item")).alias("items")))
    repeated = per_doc.withColumn("__row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return repeated.select(id_col, "text_hash", "n_words", _union_length(F.col("spans")).alias("n_hit"),
                           "items", "spans")


def _shuffled(docs: DataFrame, scanned: DataFrame, grams: DataFrame, begins: Column, same_words: Column,
              id_col: str, text_col: str) -> DataFrame:
    """``contamination`` for a set of windows that is too large to broadcast.

    A shuffled row is an id, a hash of the text, a place and a hash, so what is moved grows with
    the words. Rows without hits take no part in the join; they are added at the end.
    """
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash"))
    slim = scanned.where("place > 0").select(F.col(id_col).alias("__id"), F.col("text_hash").alias("__hash"),
                                             "place", "hash")
    met = written(slim.join(grams, "hash").drop("hash"), "met")
    held = written(met.select("__id", "__hash").distinct(), "held")
    texts = docs.select(F.col(id_col), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    back = (texts.join(small_side(held, held.count(), 40), same, "left_semi")
            .select(id_col, "text_hash", words(F.col("text")).alias("words")).dropDuplicates([id_col, "text_hash"]))
    start = F.col("place") - begins
    hits = back.join(met, same).where(same_words).select(
        "__id", "__hash", F.struct(start.cast("int").alias("start"),
                                   (start + F.col("length")).cast("int").alias("end")).alias("span"),
        F.col("item").cast("string").alias("item"))
    found = written(hits.groupBy("__id", "__hash").agg(
        F.array_sort(F.collect_set("span")).alias("spans"), F.array_sort(F.collect_set("item")).alias("items")), "hits")
    n_bytes = found.agg(F.sum(F.size("spans") * 16 + F.size("items") * 40 + 64)).first()[0] or 0
    rows = texts.select(id_col, "text_hash", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    none = {c: F.array().cast(found.schema[c].dataType) for c in ("items", "spans")}
    return (rows.join(small_side(found, n_bytes, 1), same, "left")
            .select(id_col, "text_hash", "n_words",
                    F.coalesce(_union_length(F.col("spans")), F.lit(0)).alias("n_hit"),
                    *[F.coalesce(c, none[c]).alias(c) for c in ("items", "spans")]))


def without_hit_words(text: Column, spans: Column) -> Column:
    """The text without the words inside the spans; everything between words stays."""
    gaps = F.split(text, ANY_CASE_WORD, -1)
    found = F.concat(F.regexp_extract_all(text, F.lit(ANY_CASE_WORD), F.lit(0)), F.array(F.lit("")))
    place = F.sequence(F.lit(0), F.size(gaps) - 1)

    def hit(i):
        return F.exists(spans, lambda s: (s["start"] <= i) & (i < s["end"]))
    kept = F.transform(place, lambda i: F.concat(
        F.get(gaps, i), F.when(hit(i), F.lit("")).otherwise(F.get(found, i))))
    return F.array_join(kept, "")


def decontaminated(docs: DataFrame, benchmark: DataFrame, remove: str = "documents",
                   n: int = WINDOW_WORDS, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``docs`` without contaminated rows, or (``remove="spans"``) without their hit words.

    All columns are kept; clean rows, null and empty texts stay as they are. The contaminated
    rows are found first and written; they are broadcast back only if their count allows it.
    """
    bad = written(contamination(docs, benchmark, n, id_col, text_col).where(F.col("n_hit") > 0)
                  .select(F.col(id_col).alias("__id"), F.col("text_hash").alias("__hash"),
                          F.col("spans").alias("__spans")).dropDuplicates(["__id", "__hash"]),
                  "contaminated")
    count = bad.count()
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(text_col) == F.col("__hash"))
    if remove == "documents":
        return docs.join(small_side(bad.drop("__spans"), count, 40), same, "left_anti")
    freed = F.when(F.col("__spans").isNotNull(), without_hit_words(F.col(text_col), F.col("__spans")))
    n_bytes = bad.agg(F.sum(F.size("__spans") * 16 + 64)).first()[0] or 0
    joined = docs.join(small_side(bad, n_bytes, 1), same, "left")
    return joined.select(*[F.coalesce(freed, F.col(c)).alias(c) if c == text_col else F.col(c)
                           for c in docs.columns])
