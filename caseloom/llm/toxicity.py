"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other. The model of a category sees the words of a text
and the probabilities of the categories before it; in training those are out-of-fold, so a
model learns from probabilities as good as the ones it will be given.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.llm import linear
from caseloom.llm.common import small_side, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Labelled rows a chain is fitted on at most, chosen by a hash of their id.
TRAIN_ROWS = 8_000
FOLDS = 3
THRESHOLD = 0.5
MODEL = "category int, feature array<int>, weight array<double>, more array<double>, bias double"


@dataclass(frozen=True)
class Chain:
    """Fitted models as (feature numbers, their weights, weights of earlier categories, bias)."""

    categories: tuple[str, ...]
    models: tuple[tuple, ...]

    def scored(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """All rows and columns of ``docs`` with ``p_<category>`` (0 to 1) for each category.

        Columns of those names are replaced. A null text is scored like an empty one.
        """
        names = [f"p_{c}" for c in self.categories]
        docs = docs.drop(*names)
        schema = T.StructType([*docs.schema.fields, *[T.StructField(c, T.DoubleType()) for c in names]])
        return docs.mapInArrow(_scorer(self.models, names, text_col), schema)


def _scorer(models: Sequence[tuple], names: list[str], text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = []
        for feature, weight, more, bias in models:
            weights = np.zeros(linear.HASHED_WORDS)
            weights[feature] = weight
            full.append((weights, np.array(more), bias))
        for batch in batches:
            rows = [np.zeros((0, len(names)))]
            for features in linear.document_features(batch.column(text_col)):
                rows.append(linear.chain_probabilities(features, np.array([len(features)]), full))
            found = np.concatenate(rows).round(6)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(found[:, k]) for k in range(len(names))]],
                [*batch.schema.names, *names])
    return run


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = pa.array(list(linear.document_features(batch.column("text"))), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column("fold"), batch.column("labels"), found],
                                         ["fold", "labels", "features"])


def _fitted(n_categories: int):
    """Model rows of a chain from training rows that are all in one task (a bounded sample)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, labels, folds = [np.empty(0, np.int32)], [], []
        for batch in batches:
            features += [np.array(x, np.int32) for x in batch.column("features").to_pylist()]
            labels += batch.column("labels").to_pylist()
            folds += batch.column("fold").to_pylist()
        models = linear.fit_chain(
            np.concatenate(features), np.array([len(x) for x in features[1:]], np.int64),
            np.array(labels, float).reshape(len(labels), n_categories), np.array(folds, int), FOLDS)
        used = [np.flatnonzero(weights) for weights, _, _ in models]
        yield pa.RecordBatch.from_pydict({
            "category": pa.array(range(n_categories), pa.int32()),
            "feature": pa.array([u.astype(np.int32) for u in used], pa.list_(pa.int32())),
            "weight": pa.array([m[0][u] for m, u in zip(models, used)], pa.list_(pa.float64())),
            "more": pa.array([m[1] for m in models], pa.list_(pa.float64())),
            "bias": pa.array([float(m[2]) for m in models], pa.float64())})
    return run


def training_rows(docs: DataFrame, labels: DataFrame, categories: Sequence[str],
                  max_rows: int = TRAIN_ROWS, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Labelled texts as feature numbers with their 0/1 categories and their fold.

    A document labelled several times has a category if any label says so. Rows with a null
    label, id or text are left out. At most ``max_rows`` labelled ids are used, those with the
    smallest hashes; of repeated ids the smallest text is used. Copies of a text share a fold.
    """
    known = labels.where(F.col(id_col).isNotNull()).dropna(subset=list(categories))
    merged = known.groupBy(F.col(id_col).alias("__id")).agg(
        F.array(*[F.max(F.col(c).cast("double")) for c in categories]).alias("labels"))
    chosen = merged.orderBy(F.xxhash64("__id"), "__id").limit(max_rows)
    rows = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
    labelled = (rows.join(small_side(chosen, max_rows, 32 + 8 * len(categories)), "__id")
                .groupBy("__id").agg(F.min("text").alias("text"), F.first("labels").alias("labels")))
    fold = F.pmod(F.xxhash64(F.lit("fold"), "text"), F.lit(FOLDS)).cast("int").alias("fold")
    return labelled.select(fold, "labels", "text").mapInArrow(
        _featured, "fold int, labels array<double>, features array<int>")


def fit_chain(training: DataFrame, categories: Sequence[str]) -> Chain:
    """Fit one model per category on rows made by ``training_rows``.

    The rows are a bounded sample and are fitted in one task; the driver gets the weights of
    words that enough documents hold, at most ``HASHED_WORDS`` per category. Without training
    rows all probabilities are close to 0.
    """
    ordered = written(training, "training").repartition(1).sortWithinPartitions(
        F.xxhash64("features"), F.xxhash64("labels"), "fold")
    rows = ordered.mapInArrow(_fitted(len(categories)), MODEL).collect()
    models = [(np.array(r["feature"], np.int64), np.array(r["weight"]), list(r["more"]), r["bias"])
              for r in sorted(rows, key=lambda r: r["category"])]
    if not models:  # an empty sample has no task to fit it
        models = [([], [], [0.0] * k, linear.NEVER) for k in range(len(categories))]
    return Chain(tuple(categories), tuple(models))


CATEGORIES = ("low_quality", "toxic")


def chain_for(docs: DataFrame, labels: DataFrame) -> Chain:
    """The chain over the labelled rows of ``docs``: low quality first, then toxic."""
    named = labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    return fit_chain(training_rows(docs, named, CATEGORIES), CATEGORIES)


def is_toxic(text: Column) -> Column:
    """Decision of a scored row; a null or empty text is never rejected."""
    return (F.length(F.trim(F.coalesce(text, F.lit("")))) > 0) & (F.col("p_toxic") >= THRESHOLD)
