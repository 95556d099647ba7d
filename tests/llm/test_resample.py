"""Importance resampling against brute force."""

import collections
import hashlib
import math
import re
import zlib

import pytest
from pyspark.sql import functions as F

from caseloom.llm import resample
from caseloom.llm.common import written

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, sizes):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [" ".join(words[i:i + n]) for n in sizes for i in range(len(words) - n + 1)]


def brute(docs, target, percent, least, seed, sizes, n_buckets):
    def bucket(gram):
        return zlib.crc32(gram.encode()) % n_buckets
    s = collections.Counter(bucket(g) for _, text in docs for g in grams(text, sizes)[1])
    t = collections.Counter(bucket(g) for text in target for g in grams(text, sizes)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log(((t[b] + 1.0) * (all_s + n_buckets)) / ((s[b] + 1.0) * (all_t + n_buckets))))
            for b in range(n_buckets)]
    out = {}
    for i, text in docs:
        n_words, found = grams(text, sizes)
        weight = sum(gain[bucket(g)] for g in found)
        h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[i] = (n_words, len(found), weight, score)
    order = sorted((-v[3], i) for i, v in out.items() if v[0] >= least)
    ranks = {i: k + 1 for k, (_, i) in enumerate(order[: len(order) * percent // 100])}
    return {(i, *v, ranks.get(i)) for i, v in out.items()}


@pytest.mark.parametrize("sizes,rows_per_block", [((1,), 4_000), ((1, 2), 1), ((3,), 2)])
def test_equal_to_brute_force(spark, sizes, rows_per_block):
    docs = [(i, " ".join(f"w{(i * k * k) % 61}" for k in range(i % 9 * 5)) + "—X Y" * (i % 3)) for i in range(150)]
    docs += [(200, None), (201, ""), (202, "One!! TWO... thrée 漢字 4"), (203, docs[17][1])]
    target = ["w1 w4 w9 x y", "", None, "w16 w25"]
    got = resample.resampled(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
        spark.createDataFrame([(t,) for t in target], "text string"), percent=35, least_words=5, seed=9,
        sizes=sizes, n_buckets=257, rows_per_block=rows_per_block)
    assert {tuple(r) for r in got.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()} == brute(
        docs, target, 35, 5, 9, sizes, 257)


def test_long_texts_are_scanned_in_parts(monkeypatch):
    words = resample.collapsed(" ".join(f"Word{i % 83}, the {i % 7}!" for i in range(500)))
    for n in (1, 2, 4):
        whole = resample.gram_buckets(words, [resample.gram_pattern(n)], 1_000).tolist()
        monkeypatch.setattr(resample, "SLICE_BYTES", 37)
        parts = [b for part in resample._slices(words, n)
                 for b in resample.gram_buckets(part, [resample.gram_pattern(n)], 1_000).tolist()]
        monkeypatch.setattr(resample, "SLICE_BYTES", 4_000_000)
        assert parts == whole and len(whole) == 1_500 - n + 1


def test_odd_and_empty_tables(spark, odd, none):
    target = spark.createDataFrame([("one two three",)], "text string")
    rows = odd.withColumn("rank", F.lit("own")).withColumn("weight", F.lit("own"))
    got = written(resample.resampled(rows, target, percent=50, least_words=1, n_buckets=97), "test")
    assert got.columns == [*(c for c in odd.columns if c not in ("text", "rank", "weight")),
                           "n_words", "n_features", "weight", "score", "rank"]
    assert got.count() == odd.count() and got.schema["rank"].dataType.simpleString() == "bigint"
    able = got.where("n_words >= 1").count()
    assert sorted(r["rank"] for r in got.where("rank is not null").collect()) == list(range(1, able // 2 + 1))
    assert {(r["n_words"], r["weight"]) for r in got.where("doc_id in (1, 2, 3)").collect()} == {(0, 0)}
    assert resample.resampled(none, target).count() == 0
    empty = resample.resampled(odd, target.limit(0), percent=100, least_words=1, sizes=(1,), n_buckets=97)
    assert empty.where("rank is not null").count() == able
