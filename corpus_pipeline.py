"""The corpus pipeline: filter, deduplicate, decontaminate, mix and shard documents."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from caseloom.llm import decontaminate, jaccard, mixing, shards, toxicity
from caseloom.llm.common import shared_root

N_SHARDS = 16


def _decent(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, fitted on their labelled rows, does not reject."""
    chain = toxicity.chain_for(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    own = {f"p_{c}": f"__own_p_{c}" for c in chain.categories if f"p_{c}" in docs.columns}
    scored = chain.scored(docs.withColumnsRenamed(own))
    return scored.where(~toxicity.is_toxic(scored["text"])).select(
        *[scored[own.get(c, c)].alias(c) for c in docs.columns])


def _distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links at 80 percent of five-word shingles."""
    return jaccard.one_per_group(docs, jaccard.Threshold(80, 100), n=5)


def _benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of its source takes it."""
    return mixing.mixed(docs, mixing.word_count(docs["text"]))


def _sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and its slot."""
    return shards.byte_shards(docs, N_SHARDS, shards.text_bytes(docs["text"]))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", _decent),
    ("n-gram Jaccard join", _distinct),
    ("benchmark decontamination", _benchmark_free),
    ("mixing sources", _mixed),
    ("sharding", _sharded),
]
# The classifier, the similarity join and the hash coin have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_root(spark)}/pipeline-{uuid.uuid4().hex[:12]}"
    for place, (_, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        result.write.parquet(f"{folder}/{place}")
        docs = spark.read.schema(result.schema).parquet(f"{folder}/{place}")
    return docs
