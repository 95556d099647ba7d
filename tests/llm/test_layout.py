"""Sharding, mixing, fingerprints and chat formatting."""

import zlib

from pyspark.sql import functions as F

from caseloom.llm import chat, fingerprint, mixing, shards
from caseloom.llm.common import order_blocks


def test_shards_are_contiguous_and_balanced(spark):
    docs = spark.range(2_000).select((F.col("id") * F.col("id")).alias("doc_id"),
                                     F.repeat(F.lit("x"), (F.col("id") % 97).cast("int")).alias("text"))
    placed = shards.byte_shards(docs, 7, shards.text_bytes(F.col("text")), rows_per_block=5).collect()
    total, before, seen = sum(len(r["text"]) + 1 for r in placed), 0, {}
    for r in sorted(placed, key=lambda r: r["doc_id"]):
        size = len(r["text"]) + 1
        assert r["shard"] == min(6, (2 * before + size) * 7 // (2 * total))
        assert r["slot"] == seen.get(r["shard"], 0)
        seen[r["shard"]], before = r["slot"] + 1, before + size


def test_blocks_follow_the_key_whatever_its_spread(spark):
    ids = [*range(500), *range(10**12, 10**12 + 300), -(2**62), 2**62, None, None]
    docs = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    block, n = order_blocks(docs, "doc_id", 2, F.xxhash64("doc_id"))
    rows = docs.withColumn("block", block).collect()
    ordered = sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    blocks = [r["block"] for r in ordered]
    assert blocks == sorted(blocks) and 0 <= min(blocks) and max(blocks) < n and len(set(blocks)) > 100


def test_shards_of_odd_tables(odd, none):
    placed = shards.byte_shards(odd, 4, shards.text_bytes(F.col("text")))
    assert placed.count() == odd.count() and placed.columns.count("shard") == 1
    for shard in {r["shard"] for r in placed.collect()}:
        slots = sorted(r["slot"] for r in placed.where(F.col("shard") == shard).collect())
        assert slots == list(range(len(slots)))
    assert shards.byte_shards(none, 4, shards.text_bytes(F.col("text"))).count() == 0
    sums = odd.select("text", shards.text_checksum(F.col("text")).alias("crc")).collect()
    assert all(r["crc"] == zlib.crc32((r["text"] or "").encode()) for r in sums)


def targets(sizes, weights, share=1.5, most=2):
    """The rule as it is stated: share again what is above the caps, until none is."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped = {}
    while True:
        free = [s for s in names if s not in capped]
        left = share * sum(sizes.values()) - sum(capped.values())
        over = [s for s in free if left * weight[s] / sum(weight[x] for x in free) >= most * sizes[s]]
        if not over:
            return {s: capped.get(s, left * weight[s] / sum(weight[x] for x in free) if free else 0)
                    for s in names}
        capped.update({s: float(most * sizes[s]) for s in over})


def test_targets_follow_the_weights_up_to_their_caps(spark):
    sizes = {"b": 100, "a": 5, "é": 40, None: 30, "c": 0, "d": 1000, "e": 7}
    docs = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate(sizes.items())],
                                 "doc_id long, source string, n long")
    rates = mixing.source_rates(docs, "n").collect()
    want = targets(sizes, (3, 1, 2))
    for r in rates:
        assert abs(r["target"] - want[r["__source"]]) < 1e-9 and r["rate"] <= 2
    assert abs(sum(r["target"] for r in rates) - 1.5 * sum(sizes.values())) < 1e-6


def test_mix_repeats_whole_documents(spark, odd, none):
    docs = spark.range(6_000).select(
        F.col("id").alias("doc_id"), F.lit("one two three").alias("text"),
        F.concat(F.lit("s"), F.col("id") % 3).alias("source"))
    counted = mixing.mixed_counts(docs, mixing.word_count(F.col("text")))
    sums = counted.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"),
                                         F.max("target").alias("target"), F.max("copies").alias("most"))
    for r in sums.collect():
        assert abs(r["taken"] - r["target"]) < 0.06 * r["target"] and r["most"] <= 2
    out = mixing.mixed(docs, mixing.word_count(F.col("text")))
    assert out.columns == docs.columns
    assert out.count() == counted.agg(F.sum("copies")).first()[0]
    assert sorted(map(str, counted.collect())) == sorted(map(str, mixing.mixed_counts(
        docs.repartition(5), mixing.word_count(F.col("text"))).collect()))
    odd_counts = mixing.mixed_counts(odd, mixing.word_count(F.col("text")))
    assert odd_counts.count() == odd.count() and odd_counts.where("copies is null or copies > 2").count() == 0
    assert mixing.mixed(none, mixing.word_count(F.col("text"))).count() == 0


def test_rows_without_or_with_equal_ids_toss_their_own_coins(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PART_ROWS", 500)
    n = F.col("id")
    docs = spark.range(9_000).select(
        F.when(n % 3 == 1, 7).when(n % 3 == 2, n).alias("doc_id"),
        F.when(n % 2 == 0, "one two three").otherwise(F.concat(F.lit("some text "), n)).alias("text"),
        F.concat(F.lit("s"), F.floor(n / 3) % 3).alias("source"))
    counted = mixing.mixed_counts(docs, mixing.word_count(F.col("text")))
    assert counted.count() == docs.count()
    for by in (["source"], ["source", "doc_id"]):
        sums = counted.groupBy(*by).agg(
            F.sum(F.col("size") * F.col("copies")).alias("taken"), F.sum("size").alias("of"),
            F.max(F.col("target") / F.col("source_size")).alias("rate"), F.count("*").alias("n"))
        for r in sums.where("n > 500").collect():
            assert abs(r["taken"] - r["rate"] * r["of"]) < 0.1 * r["rate"] * r["of"], r
    alike = counted.where("doc_id is null and text = 'one two three'").groupBy("source").agg(
        F.count_distinct("copies").alias("n"), F.max(F.col("target") / F.col("source_size")).alias("rate"))
    assert all(r["n"] == 2 or r["rate"] % 1 == 0 for r in alike.collect())
    again = mixing.mixed_counts(docs.repartition(5), mixing.word_count(F.col("text")))
    assert sorted(map(str, counted.collect())) == sorted(map(str, again.collect()))


def test_sketches_estimate_and_merge(spark):
    words = [f"word{i}" for i in range(4_000)]
    whole, part = " ".join(words), " ".join(words[:1_000])
    df = spark.createDataFrame([(whole, part, whole.upper())], "whole string, part string, loud string")
    s = {c: fingerprint.sketch(F.col(c)) for c in df.columns}
    row = df.select(
        fingerprint.likeness(s["whole"], s["part"]).alias("like"),
        fingerprint.containment(s["part"], s["whole"]).alias("inside"),
        (fingerprint.fingerprint(s["whole"]) == fingerprint.fingerprint(s["loud"])).alias("same"),
        (fingerprint.merged_sketch(s["part"], s["whole"]) == s["whole"]).alias("merged")).first()
    assert abs(row["like"] - 0.25) < 0.05 and row["inside"] == 1.0 and row["same"] and row["merged"]


def test_short_sketches_merge_too(spark):
    df = spark.createDataFrame([(f"t{i}", f"u{i}") for i in range(200)], "a string, b string")
    hashes = F.array_union(fingerprint.shingle_hashes(F.col("a")), fingerprint.shingle_hashes(F.col("b")))
    merged = fingerprint.merged_sketch(fingerprint.sketch(F.col("a")), fingerprint.sketch(F.col("b")))
    assert df.where(fingerprint._scaled(hashes, fingerprint.SCALE) != merged).count() == 0


def test_next_in_descending_order(spark, odd, none):
    ids = [*range(0, 900, 3), 10**14, -5]
    docs = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string").repartition(4)
    rows = fingerprint.with_next(docs, ["text"], ["text"], rows_per_block=1).collect()
    down = sorted(ids, reverse=True)
    want = {i: f"text {down[(k + 1) % len(down)]}" for k, i in enumerate(down)}
    assert {r["doc_id"]: r["next_text"] for r in rows} == want and len(rows) == len(ids)
    odd_rows = fingerprint.with_next(odd.select("doc_id", "text"), ["text"], ["text"], rows_per_block=1)
    assert odd_rows.count() == odd.count()
    alone = fingerprint.with_next(docs.where("doc_id = 3"), ["text"], ["text"]).first()
    assert alone["next_text"] == "text 3"
    assert fingerprint.with_next(none.select("doc_id", "text"), ["text"], ["text"]).count() == 0


def test_edit_counts_code_points(spark):
    df = spark.createDataFrame([("é😀漢abc", "XY"), ("ab", "cd"), ("", "z")], "a string, b string")
    out = [r[0] for r in df.select(fingerprint.edited(F.col("a"), F.col("b"))).collect()]
    assert out == ["é😀漢aXY", "ab", ""]


def turns(side, *rows):
    return [(1, side, i, role, text) for i, (role, text) in enumerate(rows)]


TURN = "pair_id long, side string, turn int, role string, text string"


def test_common_turns_become_the_prompt(spark):
    rows = (turns("chosen", ("user", "hi"), ("assistant", "yes"), ("user", "é"), ("assistant", "good"))
            + turns("rejected", ("user", "hi"), ("assistant", "yes"), ("assistant", "bad")))
    got = chat.preference_records(spark.createDataFrame(rows * 2, TURN)).first()
    assert got["prompt"] == "<|user|>\nhi<|end|>\n<|assistant|>\nyes<|end|>\n" and got["prompt_turns"] == 2
    for side, texts in (("chosen", ["good"]), ("rejected", ["bad"])):
        cut = [got[side][a:b] for a, b in got[f"{side}_mask"]]
        assert cut == [t + chat.END for t in texts]


def test_equal_missing_and_null_turns(spark):
    same = turns("chosen", ("user", None), ("assistant", "a")) + turns("rejected", ("user", ""), ("assistant", "a"))
    got = chat.preference_records(spark.createDataFrame(same, TURN)).first()
    assert (got["prompt_turns"], got["chosen"], got["rejected"], got["chosen_mask"]) == (2, "", "", [])
    one = chat.preference_records(spark.createDataFrame(turns("chosen", (None, "x")), TURN)).first()
    assert (one["prompt"], one["chosen"], one["rejected"]) == ("", "<||>\nx<|end|>\n", "")
    lost = spark.createDataFrame([(None, "chosen", 0, "user", "x")], TURN)
    assert chat.preference_records(lost).count() == 0


def test_sibling_pairs(spark):
    rows = [(2, 0, "user", "q"), (2, 1, "assistant", "a"), (3, 0, "user", "q"), (3, 1, "assistant", "b"),
            (5, 0, "user", "alone"), (5, 1, "assistant", "c"), (7, 0, "user", "mute")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["pair_id"]: r for r in chat.preference_records(chat.sibling_pairs(table)).collect()}
    assert "b" in got[2]["rejected"] and "a" in got[2]["chosen"] and got[2]["prompt_turns"] == 1
    assert got[5]["rejected"] == "" and got[7]["prompt_turns"] == 1 and got[7]["chosen"] == ""


def test_texts_are_shuffled_once(spark):
    table = spark.createDataFrame([(2, 0, "user", "q")], "conv_id long, turn long, role string, text string")
    for records in (chat.preference_records(chat.sibling_pairs(table), ["siblings"]),
                    chat.preference_records(spark.createDataFrame(turns("chosen", ("user", "hi")), TURN))):
        assert records._jdf.queryExecution().executedPlan().toString().count("Exchange hash") == 1


def test_no_and_very_many_turns(spark):
    table = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.preference_records(chat.sibling_pairs(table), ["siblings"]).count() == 0
    assert chat.preference_records(spark.createDataFrame([], TURN)).count() == 0
    n = 100_000
    role = F.when(F.col("id") % 2 == 0, "user").otherwise("assistant")
    long = spark.range(n).select(F.lit(1).cast("long").alias("pair_id"), F.explode(F.array(F.lit("chosen"), F.lit("rejected")))
                                 .alias("side"), F.col("id").cast("int").alias("turn"), role.alias("role"),
                                 F.concat(F.lit("t"), F.col("id")).alias("text"))
    changed = long.withColumn("text", F.when((F.col("side") == "rejected") & (F.col("turn") == n // 2), "other")
                              .otherwise(F.col("text")))
    got = chat.preference_records(changed).first()
    assert got["prompt_turns"] == n // 2 and len(got["chosen_mask"]) == n // 4
    start, end = got["chosen_mask"][-1]
    assert got["chosen"][start:end] == f"t{n - 1}" + chat.END and end == len(got["chosen"])


def test_replies_of_null_and_repeated_turns(spark):
    rows = [(2, None, "assistant", "a"), (2, None, "user", None), (3, 1, "assistant", None), (3, 1, "assistant", None),
            (None, 1, "user", "lost")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["pair_id"]: r for r in chat.preference_records(chat.sibling_pairs(table), ["siblings"]).collect()}
    assert set(got) == {2, 3} and got[3]["chosen"].endswith("\n<|end|>\n") and "a<|end|>" in got[3]["rejected"]
