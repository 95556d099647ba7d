"""Token counts at every prefix against the library, which encodes each prefix anew."""

import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from caseloom.llm import tokencounts
from caseloom.llm.queries import QUERIES

JSON = tokencounts.read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
PARTS = [" ", "  ", "\n", "\t", "'", "'s", "'re", "'ll", "'ve", "word", " the", "token", "ization", "12", "345",
         "!", "!!", "...", "é", "漢字", "😀", "<|endoftext|>", "<|", "　", "\x85", "\x1c", "՘", "don't",
         "=====", "aaaaaaa", "\U00011d00", "        "]


@pytest.fixture(scope="module")
def counter():
    return tokencounts.PrefixCounts(JSON)


def encoded(counter, text):
    return len(counter.library.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("slice_chars", [5, 1_000_000])
def test_every_prefix_as_the_library_counts_it(counter, monkeypatch, slice_chars):
    monkeypatch.setattr(tokencounts, "SLICE_CHARS", slice_chars)
    rnd = random.Random(7)
    for _ in range(700):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 14)))
        want = [encoded(counter, text[:k]) for k in range(len(text) + 1)]
        assert np.concatenate(list(counter.counts(text))).tolist() == want
        for budget in (0, 1, 3, 7):
            longest = max(k for k, n in enumerate(want) if n <= budget)
            assert counter.measured(text, budget) == (want[-1], longest)


def test_settled_characters_are_split_as_the_library_splits_them(counter):
    assert not counter.odd("aé漢😀　\n")
    for c in map(chr, [*range(0x558), *range(0x2000, 0x2070), *range(0x3000, 0xA000, 7), *range(0xAC00, 0xD7A4, 31),
                       *range(0xFF00, 0xFFF0), *range(0x1F300, 0x1FA00)]):
        text = f"a{c}1{c}!{c} {c}\n{c}"
        assert not counter.odd(text)
        assert [text[a:b] for _, (a, b) in counter.library.pre_tokenizer.pre_tokenize_str(text)] == counter.pieces_of(text)


def test_forgetting_pieces_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokencounts, "KEPT_PIECES", 3)
    small = tokencounts.PrefixCounts(JSON)
    text = "some words that come again, some words that do not; " * 4
    assert small.measured(text, 10)[0] == encoded(small, text) and len(small) <= 3


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        tokencounts.PrefixCounts(tokencounts.read_tokenizer(public_tokenizers.path("word_bpe_49k.json")))


def test_query_equals_the_library(spark, sf_dir, counter):
    rows = pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()
    want = {}
    for r in rows:
        text, n = r["text"] or "", encoded(counter, r["text"] or "")
        want[r["doc_id"]] = (len(text.encode()), n, n > 512)
    got = QUERIES["op11_token_counts"](spark, sf_dir).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got} == want
    for r, text in [(r, t) for r in got for t in [next(d["text"] for d in rows if d["doc_id"] == r["doc_id"])]][:40]:
        if r["over_limit"]:
            assert encoded(counter, text[:r["n_within"]]) <= 512 < encoded(counter, text[:r["n_within"] + 1])


def test_stored_counts_answer_questions(spark, odd, counter, monkeypatch):
    texts = {(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()}
    stored = tokencounts.prefix_counts(odd, JSON).dropDuplicates(["id", "key", "part"]).cache()
    assert stored.where(F.size("counts") > tokencounts.PART_CHARS).count() == 0
    long = next(t for i, t in texts if i == 4)
    asked = spark.createDataFrame([(4, 0), (4, 4_095), (4, 4_096), (4, 9_001), (4, len(long)), (4, len(long) + 1),
                                   (2, 0), (7, 3), (99, 1)], "id long, length long")
    got = {(r["id"], r["length"]): r["n_tokens"] for r in tokencounts.tokens_at(stored, asked).collect()}
    assert got == {**{(4, k): encoded(counter, long[:k]) for k in (0, 4_095, 4_096, 9_001, len(long))},
                   (4, len(long) + 1): None, (2, 0): 0, (7, 3): encoded(counter, "sho"), (99, 1): None}
    cut = {r["id"]: r["length"] for r in tokencounts.longest_within(stored, 9).where("id in (1, 2, 4, 7)").collect()}
    assert cut == {i: counter.measured(t or "", 9)[1] for i, t in texts if i in (1, 2, 4, 7)}


def test_odd_and_empty_tables(odd, none, counter):
    found = tokencounts.token_counts(odd.withColumn("n_tokens", F.lit("own")), JSON, 5)
    assert found.columns == [*(c for c in odd.columns if c != "text"), "n_tokens", "n_within"]
    texts = sorted((r["doc_id"] or 0, r["text"] or "") for r in odd.collect())
    assert sorted(r["n_tokens"] for r in found.collect()) == sorted(encoded(counter, t) for _, t in texts)
    assert tokencounts.token_counts(none, JSON, 5).collect() == [] and tokencounts.prefix_counts(none, JSON).count() == 0
