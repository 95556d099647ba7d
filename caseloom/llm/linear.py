"""Logistic regressions over hashed words, in numpy: the small core of the classifier chain."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from caseloom.llm.wordhash import mixed, text_slices, word_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HASHED_WORDS = 2**20
BEGINNING = 4
#: Documents that must hold a word before a model looks at it.
LEAST_DOCS = 3
STEPS = 40
#: Log odds of a category that no training row has.
NEVER = -12.0


def _letters_only(data: np.ndarray) -> np.ndarray:
    """ASCII characters other than letters and digits become spaces."""
    ascii_other = ((data < 48) | ((data > 57) & (data < 65)) | ((data > 90) & (data < 97))
                   | ((data > 122) & (data < 128)))
    return np.where(ascii_other, np.uint8(32), data)


def _beginnings(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The same bytes with all but the first characters of each word made spaces."""
    inner = data != 32
    place = np.arange(len(data))
    opens = inner.copy()
    opens[1:] &= ~inner[:-1]
    first = offsets[:-1][offsets[:-1] < len(data)]
    opens[first] |= inner[first]
    since = place - np.maximum.accumulate(np.where(opens, place, 0))
    return np.where(since < BEGINNING, data, np.uint8(32))


def document_features(texts: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct feature numbers of each text: its words and their first four bytes."""
    for _, data, offsets in text_slices(texts):
        data = _letters_only(data)
        words, rows = word_hashes(data, offsets)
        starts, _ = word_hashes(_beginnings(data, offsets), offsets)
        words = words % np.uint64(HASHED_WORDS)
        starts = mixed(starts) % np.uint64(HASHED_WORDS)
        for row in range(len(offsets) - 1):
            a, b = rows[row], rows[row + 1]
            yield np.unique(np.concatenate([words[a:b], starts[a:b]])).astype(np.int32)


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of the values of each row; rows end where ``ends`` says."""
    total = np.concatenate([[0.0], np.cumsum(values)])
    return np.diff(total[np.concatenate([[0], ends])])


def fit(features: np.ndarray, lengths: np.ndarray, extra: np.ndarray, labels: np.ndarray):
    """(weights of features, of extra columns, bias) of a logistic regression.

    Words are scaled by the smoothed log ratio of their frequencies in the two classes, so a
    few gradient steps find the words that matter. Without both classes the weights are 0 and
    the bias gives the only class (the negative one without rows).
    """
    weights, more = np.zeros(HASHED_WORDS), np.zeros(extra.shape[1])
    n, positive = len(labels), float(labels.sum())
    if not 0 < positive < n:
        return weights, more, -NEVER if positive else NEVER
    doc = np.repeat(np.arange(n), lengths)
    held = np.bincount(features, minlength=HASHED_WORDS)
    held_positive = np.bincount(features, weights=labels[doc], minlength=HASHED_WORDS)
    share = positive / n
    smooth = 10.0
    ratio = (np.log((held_positive + smooth * share) / positive)
             - np.log((held - held_positive + smooth * (1 - share)) / (n - positive)))
    ratio[held < LEAST_DOCS] = 0.0
    used = ratio[features] != 0
    features, doc = features[used], doc[used]
    kept, features = np.unique(features, return_inverse=True)
    ratio, size = ratio[kept], len(kept)
    ends = np.cumsum(np.bincount(doc, minlength=n))
    # Gradient steps scaled by each weight's curvature, with momentum and weight decay.
    curve = np.bincount(features, minlength=size) * 0.25 * ratio**2 + 1.0
    decay, rate = 2.0, 0.05
    bias = float(np.log(share / (1 - share)))
    scale = np.zeros(size)
    speed, speed_more, speed_bias = np.zeros(size), np.zeros(extra.shape[1]), 0.0
    for _ in range(STEPS):
        score = _sums((ratio * scale)[features], ends) + extra @ more + bias
        error = labels - 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        slope = np.bincount(features, weights=error[doc], minlength=size) * ratio
        speed = 0.9 * speed + rate * (slope - decay * scale) / curve
        scale += speed
        speed_more = 0.9 * speed_more + rate * (extra.T @ error - decay * more) / (0.25 * n)
        more = more + speed_more
        speed_bias = 0.9 * speed_bias + rate * float(error.sum()) / (0.25 * n)
        bias += speed_bias
    weights[kept] = ratio * scale
    return weights, more, bias


def probabilities(features: np.ndarray, lengths: np.ndarray, extra: np.ndarray, model) -> np.ndarray:
    weights, more, bias = model
    score = _sums(weights[features], np.cumsum(lengths)) + extra @ more + bias
    return 1 / (1 + np.exp(-np.clip(score, -30, 30)))


def fit_chain(features: np.ndarray, lengths: np.ndarray, labels: np.ndarray, folds: np.ndarray,
              n_folds: int) -> list:
    """One model per column of ``labels``; each sees out-of-fold probabilities of those before."""
    extra = np.zeros((len(lengths), 0))
    row = np.repeat(np.arange(len(lengths)), lengths)
    models = []
    for category in range(labels.shape[1]):
        y = labels[:, category]
        models.append(fit(features, lengths, extra, y))
        if category + 1 == labels.shape[1]:
            break
        held_out = np.zeros(len(lengths))
        for fold in range(n_folds):
            out = folds == fold
            model = fit(features[~out[row]], lengths[~out], extra[~out], y[~out])
            held_out[out] = probabilities(features[out[row]], lengths[out], extra[out], model)
        extra = np.column_stack([extra, held_out])
    return models


def chain_probabilities(features: np.ndarray, lengths: np.ndarray, models: list) -> np.ndarray:
    """Probabilities of all categories, in chain order, one row per document."""
    extra = np.zeros((len(lengths), 0))
    for model in models:
        extra = np.column_stack([extra, probabilities(features, lengths, extra, model)])
    return extra
