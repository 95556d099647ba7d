"""Registered queries against their SQL, or against brute force where SQL has no form for them."""

import collections
import hashlib
import re
import zlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from caseloom.llm import toxicity
from caseloom.llm.queries import ORACLES, QUERIES
from tests.llm.test_similarity import brute_components
from tests.oracle_check import compare


def rows_of(sf_dir, table):
    return pq.read_table(f"{sf_dir}/{table}.parquet").to_pylist()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    problems = [p for p in compare(spark, sf_dir, name, QUERIES[name], ORACLES[name]) if not p.startswith("type")]
    assert not problems


def shard_of(docs):
    """(shard, slot) of each (id, text) in order, cut at equal byte targets."""
    sizes = [len((text or "").encode()) + 1 for _, text in docs]
    before, seen, out = 0, collections.Counter(), []
    for size in sizes:
        shard = min(15, (2 * before + size) * 16 // (2 * sum(sizes)))
        out.append((size, shard, seen[shard]))
        before, seen[shard] = before + size, seen[shard] + 1
    return out


def test_shards_equal_brute_force(spark, sf_dir):
    docs = sorted((r["doc_id"], r["text"]) for r in rows_of(sf_dir, "documents"))
    want = {(i, size, zlib.crc32((text or "").encode()), "bytes", shard, slot, None)
            for (i, text), (size, shard, slot) in zip(docs, shard_of(docs))}
    assert {tuple(r) for r in QUERIES["op6_byte_shards"](spark, sf_dir).collect()} == want


def test_every_later_line_goes(spark, sf_dir):
    seen, want, short = set(), set(), 0
    for r in sorted(rows_of(sf_dir, "documents"), key=lambda r: r["doc_id"]):
        kept, spans, start = [], [], 0
        for line in (r["text"] or "").split("\n"):
            words = tuple(line.lower().split())
            if words in seen:
                spans.append(f"{start}:{start + len(line)}")
                short += len(words) < 6
            else:
                kept.append(line)
            seen |= {words} if words else set()
            start += len(line) + 1
        want.add((r["doc_id"], len(spans), ",".join(spans), None if r["text"] is None else "\n".join(kept)))
    got = QUERIES["op8_repeated_lines"](spark, sf_dir).select("doc_id", "n_removed", "spans", "text")
    assert short and {tuple(r) for r in got.collect()} == want


def five_shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_fingerprints_equal_brute_force(spark, sf_dir):
    docs = sorted(((r["doc_id"], r["text"] or "") for r in rows_of(sf_dir, "documents")), reverse=True)
    got = {r["doc_id"]: r for r in QUERIES["op5_fingerprint"](spark, sf_dir).collect()}
    errors, prints = [], {}
    for place, (doc_id, text) in enumerate(docs):
        following = docs[(place + 1) % len(docs)][1]
        cut = len(text) // 3
        edited = text[:len(text) - cut] + following[:cut]
        row = got[doc_id]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, row["fingerprint"]) == row["fingerprint"]
        for name, other in (("near_edited", edited), ("near_next", following)):
            a, b = five_shingles(text), five_shingles(other)
            errors.append(abs(row[name] - (len(a & b) / len(a | b) if a | b else 1.0)))
    assert len(got) == len(docs) and sum(errors) / len(errors) < 0.05


def test_components_equal_brute_force_on_the_table(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in rows_of(sf_dir, "documents")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in QUERIES["op7_jaccard_join"](spark, sf_dir).collect()}
    assert got == brute_components(docs, 4, 85, 100)


def test_toxicity_of_every_document(spark, sf_dir):
    got = {r["doc_id"]: r for r in QUERIES["op2_toxicity"](spark, sf_dir).collect()}
    labels = rows_of(sf_dir, "labels")
    assert len(got) == len(rows_of(sf_dir, "documents"))
    wrong = [r for r in labels if not r["toxic"] and got[r["doc_id"]]["toxic"]]
    assert len(wrong) <= 0.02 * len(labels)


def item_windows(sf_dir):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = set()
    for r in rows_of(sf_dir, "benchmark"):
        words = pattern.findall(re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or ""))
        windows |= {tuple(words[i:i + 10]) for i in range(max(1, len(words) - 9))} if words else set()

    def hit(text):
        words = pattern.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return any(tuple(words[i:i + n]) in windows for n in {len(w) for w in windows}
                   for i in range(len(words) - n + 1))
    return hit


def mix_copies(docs):
    """How often each (id, text, source) is taken."""
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", text or "")) for i, text, _ in docs}
    sums = collections.Counter()
    for i, _, source in docs:
        sums[source] += size[i]
    names = sorted(sums, key=lambda s: (s is None, s or ""))
    weight, capped = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}, {}
    while True:
        free = [s for s in names if s not in capped]
        left = 1.5 * sum(sums.values()) - sum(capped.values())
        over = [s for s in free if left * weight[s] / sum(weight[x] for x in free) >= 2 * sums[s]]
        if not over:
            break
        capped.update({s: 2.0 * sums[s] for s in over})
    rate = {s: capped.get(s, left * weight[s] / sum(weight[x] for x in free) if free else 0) / sums[s] if sums[s] else 0
            for s in names}

    def coin(i):
        return int(hashlib.md5(f"mix:{i}".encode()).hexdigest()[:12], 16) / 16**12
    return {i: int(rate[s]) + (coin(i) < rate[s] % 1) for i, _, s in docs}


def test_pipeline_equals_brute_force(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    chain = toxicity.chain_for(table, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    toxic = {r[0] for r in chain.scored(table).where(toxicity.is_toxic(F.col("text"))).select("doc_id").collect()}
    docs = [(r["doc_id"], r["text"], r["source"]) for r in rows_of(sf_dir, "documents") if r["doc_id"] not in toxic]
    groups = brute_components([d[:2] for d in docs], 5, 80, 100)
    docs = [d for d in docs if groups[d[0]][1] == d[0]]
    hit = item_windows(sf_dir)
    docs = [d for d in docs if not hit(d[1])]
    copies = mix_copies(docs)
    mixed = sorted((i, text) for i, text, _ in docs for _ in range(copies[i]))
    want = sorted((i, shard, slot) for (i, _), (_, shard, slot) in zip(mixed, shard_of(mixed)))
    out = corpus_pipeline.run(spark, sf_dir)
    assert set(out.columns) == {*table.columns, "shard", "slot"}
    assert sorted((r["doc_id"], r["shard"], r["slot"]) for r in out.collect()) == want
