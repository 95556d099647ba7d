"""Registered queries of the operators: thin digests over their whole tables."""

from __future__ import annotations

import importlib
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm import (
    chat, decontaminate, fingerprint, jaccard, licences, mixing, oracles, repeats, resample, secrets,
    shards, spelling, tokencounts, toxicity)
from caseloom.llm.common import shared_root

TOKENIZER = "byte_bpe_50k.json"
#: Words of removed lines in a row that count as a repeated passage and not as a repeated phrase.
PASSAGE_WORDS = 20


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt and masked completions of every conversation against its sibling's last reply."""
    pairs = chat.sibling_pairs(_table(spark, sf_dir, "conversations"))
    return chat.preference_records(pairs, dealt_by=["siblings"]).select(
        "pair_id", "prompt_turns", "prompt", "chosen", _spans("chosen_mask"),
        "rejected", _spans("rejected_mask"))


def _spans(column: str) -> Column:
    """Spans as text, start:end, joined by commas."""
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias(column)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of the categories and the decision for every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.chain_for(docs, _table(spark, sf_dir, "labels")).scored(docs)
    return scored.select("doc_id", "p_low_quality", "p_toxic", toxicity.is_toxic(F.col("text")).alias("toxic"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, each distinct text scanned once, by a ledger that starts empty."""
    versions = _table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = secrets.Ledger(spark, f"{shared_root(spark)}/ledger-{uuid.uuid4().hex[:12]}")
    ledger.scan(versions)
    found = secrets.located(versions, ledger.findings())
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2("spans", 256).alias("base_sha256"), "spans", "blob")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words and items found in every document."""
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"),
                                        _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sketched = docs.withColumn("sketch", fingerprint.sketch(F.col("text")))
    rows = fingerprint.with_next(sketched, ["text", "sketch"], tie_cols=["text"])
    rows = rows.withColumn("edited", fingerprint.edited(F.col("text"), F.col("next_text")))
    rows = rows.withColumn("edited_sketch", fingerprint.sketch(F.col("edited")))
    return rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint.fingerprint(F.col("sketch")).alias("fingerprint"),
        fingerprint.fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprint.likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fingerprint.likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))


def op6_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen contiguous shards of nearly equal bytes."""
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", shards.text_bytes(F.col("text")).alias("size"),
        shards.text_checksum(F.col("text")).alias("text_crc32"))
    placed = shards.byte_shards(docs, 16, F.col("size"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that link at 85 percent of their four-word shingles."""
    groups = jaccard.similar_groups(_table(spark, sf_dir, "documents"), jaccard.Threshold(85, 100), n=4)
    return groups.select("doc_id", "n_shingles", "component_id")


def op8_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without later occurrences of lines that have a word, and where they were."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = repeats.deduplicated(docs, counted=True)
    return found.select("doc_id", F.size("spans").cast("long").alias("n_removed"),
                        _spans("spans").alias("spans"), "text", "removed_words", "longest_removed",
                        (F.col("longest_removed") >= PASSAGE_WORDS).alias("repeats_passage"))


def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document by its known sentences."""
    found = licences.licences(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_sentences", "sequence", F.array_join("licences", ",").alias("licences"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes from every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    counted = mixing.mixed_counts(docs, mixing.word_count(F.col("text")))
    return counted.select("doc_id", "size", "source_size", "target",
                          (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and how much of it a budget of 512 tokens holds."""
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    path = importlib.import_module("public_tokenizers").path(TOKENIZER)
    counted = tokencounts.token_counts(docs, tokencounts.read_tokenizer(path), limit=512)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"), "n_within")


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document towards the benchmark texts, on single words."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = resample.resampled(docs, _table(spark, sf_dir, "benchmark"), percent=10, least_words=20,
                               seed=2024, sizes=(1,), n_buckets=10_000)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, their near words, and the form and root each may be a variant of."""
    found = spelling.variant_groups(_table(spark, sf_dir, "documents"), least_length=5, least_count=3, times=2)
    return found.select("word", "form", "root", "n", "n_near", "form_n")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_preference_format": op1_preference_format,
    "op2_toxicity": op2_toxicity,
    "op3_secret_scan": op3_secret_scan,
    "op4_decontamination": op4_decontamination,
    "op5_fingerprint": op5_fingerprint,
    "op6_byte_shards": op6_byte_shards,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_repeated_lines": op8_repeated_lines,
    "op9_licence_scan": op9_licence_scan,
    "op10_mixing": op10_mixing,
    "op11_token_counts": op11_token_counts,
    "op12_importance": op12_importance,
    "op13_spelling": op13_spelling,
}

ORACLES = oracles.ORACLES
