"""The classifier chain of the query, fitted and applied again in plain numpy on dense tables."""

import re

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from caseloom.llm import linear, toxicity
from caseloom.llm.queries import QUERIES

WORD = re.compile(rb"[0-9A-Za-z\x80-\xFF]+")
ONES = 2**64 - 1


def scrambled(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & ONES
    x = (x ^ x >> 27) * 0x94D049BB133111EB & ONES
    return x ^ x >> 31


def hashed(word):
    return scrambled(sum((b + 1) * pow(0x9E3779B97F4A7C15, k + 1, 2**64) for k, b in enumerate(word.lower())) & ONES)


def features(text):
    """Numbers of the words, and of their beginnings, which are scrambled once more."""
    words = set(WORD.findall((text or "").encode()))
    return ({hashed(w) % linear.HASHED_WORDS for w in words}
            | {scrambled(hashed(w[:4])) % linear.HASHED_WORDS for w in words})


def table(rows, columns):
    place = {f: k for k, f in enumerate(columns)}
    out = np.zeros((len(rows), len(columns)))
    for i, found in enumerate(rows):
        for f in found & place.keys():
            out[i, place[f]] = 1
    return out


def dense_fit(x, extra, y):
    n, positive = len(y), y.sum()
    if not 0 < positive < n:
        return np.zeros(x.shape[1]), np.zeros(extra.shape[1]), -linear.NEVER if positive else linear.NEVER
    share, held = positive / n, x.sum(axis=0)
    with_it = y @ x
    ratio = np.log((with_it + 10 * share) / positive) - np.log((held - with_it + 10 * (1 - share)) / (n - positive))
    ratio[held < linear.LEAST_DOCS] = 0
    scaled = x * ratio
    curve = held * 0.25 * ratio**2 + 1
    w, more, bias = np.zeros(x.shape[1]), np.zeros(extra.shape[1]), np.log(share / (1 - share))
    speeds = [np.zeros_like(w), np.zeros_like(more), 0.0]
    for _ in range(linear.STEPS):
        error = y - 1 / (1 + np.exp(-np.clip(scaled @ w + extra @ more + bias, -30, 30)))
        slopes = ((error @ scaled - 2 * w) / curve, (extra.T @ error - 2 * more) / (0.25 * n), error.sum() / (0.25 * n))
        speeds = [0.9 * s + 0.05 * slope for s, slope in zip(speeds, slopes)]
        w, more, bias = w + speeds[0], more + speeds[1], bias + speeds[2]
    return ratio * w, more, bias


def apply(model, x, extra):
    return 1 / (1 + np.exp(-np.clip(x @ model[0] + extra @ model[1] + model[2], -30, 30)))


def test_probabilities_of_every_document(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()}
    labels = {r["doc_id"]: (1 - r["quality"], r["toxic"]) for r in pq.read_table(f"{sf_dir}/labels.parquet").to_pylist()}
    ids = [i for i in labels if docs.get(i) is not None]
    assert 50 < len(ids) <= toxicity.TRAIN_ROWS
    fold_of = {r["doc_id"]: r["fold"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", F.pmod(F.xxhash64(F.lit("fold"), "text"), F.lit(toxicity.FOLDS)).alias("fold")).collect()}
    found = {i: features(t) for i, t in docs.items()}
    columns = sorted(set().union(*(found[i] for i in ids)))
    x, y = table([found[i] for i in ids], columns), np.array([labels[i] for i in ids], float)
    folds = np.array([fold_of[i] for i in ids])
    none = np.zeros((len(ids), 0))
    first = dense_fit(x, none, y[:, 0])
    held_out = np.zeros((len(ids), 1))
    for fold in range(toxicity.FOLDS):
        out = folds == fold
        held_out[out, 0] = apply(dense_fit(x[~out], none[~out], y[~out, 0]), x[out], none[out])
    second = dense_fit(x, held_out, y[:, 1])
    everyone = list(docs)
    x = table([found[i] for i in everyone], columns)
    p_first = apply(first, x, np.zeros((len(everyone), 0)))
    p_second = apply(second, x, p_first[:, None])
    got = {r["doc_id"]: r for r in QUERIES["op2_toxicity"](spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for i, a, b in zip(everyone, p_first, p_second):
        assert abs(got[i]["p_low_quality"] - a) < 2e-6 and abs(got[i]["p_toxic"] - b) < 2e-6
        assert got[i]["toxic"] == (bool((docs[i] or "").strip(" ")) and got[i]["p_toxic"] >= toxicity.THRESHOLD)
