"""The similarity join against brute force, and the classifier chain."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from caseloom.llm import jaccard, linear, toxicity
from caseloom.llm.wordhash import shingle_sets


def shingles(text, n):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute_components(docs, n, num, den):
    sets = {i: shingles(t, n) for i, t in docs}
    place = {i: i for i in sets}

    def top(i):
        while place[i] != i:
            i = place[i]
        return i
    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y] and top(x) != top(y):
                shared = len(sets[x] & sets[y])
                if den * shared >= num * (len(sets[x]) + len(sets[y]) - shared):
                    a, b = sorted((top(x), top(y)))
                    place[b] = a
    return {i: (len(sets[i]), top(i)) for i in ids}


def edited_corpus(seed, groups=14, copies=9):
    """Groups of texts at all distances around the threshold, sharing one passage."""
    rng, docs = random.Random(seed), []
    passage = [f"p{i}" for i in range(25)]
    for _ in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([4, 9, 20, 60, 150, 400]))]
        base = base + passage if rng.random() < 0.5 else base
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 25))):
                text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
            if rng.random() < 0.3:
                text = text[: max(1, int(len(text) * rng.uniform(0.85, 1)))]
            docs.append(" ".join(text))
            base = text if rng.random() < 0.5 else base  # chains of copies of copies
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("seed, n, num", [(1, 4, 85), (2, 5, 80)])
def test_components_equal_brute_force(spark, seed, n, num):
    docs = edited_corpus(seed)
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = jaccard.similar_groups(table, jaccard.Threshold(num, 100), n=n)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == \
        brute_components(docs, n, num, 100)


@pytest.mark.parametrize("classes, shingles_held", [(3, 10**9), (10**9, 900), (1, 10**9)])
def test_blocks_of_large_gatherings(spark, monkeypatch, classes, shingles_held):
    monkeypatch.setattr(jaccard, "BLOCK_CLASSES", classes)
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", shingles_held)
    docs = edited_corpus(5, groups=8, copies=12)
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = jaccard.similar_groups(table, jaccard.Threshold(80, 100), n=4)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == brute_components(docs, 4, 80, 100)


def long_near_copies(seed, n=70, words=1_500):
    """Copies of one long text around the threshold against it, far below it against each other."""
    rng = random.Random(seed)
    base, docs = [f"w{rng.randrange(9_000)}" for _ in range(words)], []
    for _ in range(n):
        text = list(base)
        for _ in range(rng.choice([10, 30, 38, 42, 60, 90])):
            text[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        docs.append(" ".join(text))
    return list(enumerate(docs))


def test_long_near_copies_below_the_threshold(spark):
    docs = long_near_copies(11)
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = jaccard.similar_groups(table, jaccard.Threshold(85, 100), n=4)
    want = brute_components(docs, 4, 85, 100)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == want
    assert 3 < len({c for _, c in want.values()}) < len(docs)


def test_a_unit_emits_connecting_links_only():
    sets = [s for _, s in shingle_sets(pa.array([t for _, t in long_near_copies(12, n=50)]), 4)]
    t = jaccard.Threshold(80, 100)
    alone = np.array([str(i) for i in range(len(sets))])
    links = jaccard.connecting_links(sets, alone, 0, t)
    components = brute_components(long_near_copies(12, n=50), 4, 80, 100)
    assert len(links) == len(sets) - len({c for _, c in components.values()})
    assert all(components[i][1] == components[j][1] for i, j in links)
    half = jaccard.connecting_links(sets, alone, 20, t)
    assert all(i < 20 <= j for i, j in half) and len(half) < len(sets)
    joined = np.array([str(components[i][1]) for i in range(len(sets))])
    assert jaccard.connecting_links(sets, joined, 0, t) == []


@pytest.mark.parametrize("num", [80, 85, 95])
def test_linked_sets_always_share_a_tile(num):
    rng, t = np.random.default_rng(num), jaccard.Threshold(num, 100)
    linked = 0
    for _ in range(1_500):
        a = np.unique(rng.integers(0, 2**63, rng.choice([3, 7, 12, 30, 100, 700]), dtype=np.uint64))
        gone, more = (rng.integers(0, max(2, int(len(a) * (100 - num) / 90))) for _ in range(2))
        b = np.unique(np.concatenate([rng.permutation(a)[gone:], rng.integers(0, 2**63, more, dtype=np.uint64)]))
        shared = len(np.intersect1d(a, b))
        bound = jaccard.overlap_bound(jaccard.bitmap(a), jaccard.bitmap(b), len(a), len(b))
        assert bound >= shared
        if t.linked(shared, len(a), len(b)) and shared < max(len(a), len(b)):
            linked += 1
            assert np.intersect1d(jaccard.tile_signatures(a, t), jaccard.tile_signatures(b, t)).size
            bands = [(set(x.tolist()) & set(y.tolist()), max(p, q)) for x, p in jaccard.band_signatures(a, t)
                     for y, q in jaccard.band_signatures(b, t)]
            assert any(len(both) > spare for both, spare in bands)
    assert linked > 100


def test_shingles_of_odd_texts():
    texts = [None, "", " \t\n", "One", "one TWO three four", "one two  three\x0bfour ONE TWO THREE FOUR", "É é", "É É É É"]
    sets = dict(shingle_sets(pa.array(texts), 4))
    assert [len(sets[i]) for i in range(len(texts))] == [len(shingles(t, 4)) for t in texts]
    assert sets[4][0] in sets[5] and len(sets) == len(texts)
    sliced = dict(shingle_sets(pa.array(texts).slice(3, 2), 4))
    assert (sliced[1] == sets[4]).all()


def test_components_of_odd_tables(odd, none):
    rows = jaccard.similar_groups(odd).collect()
    assert len(rows) == odd.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], set()).add((r["n_shingles"], r["component_id"]))
    assert by_id[1] == {(0, 1)} and by_id[2] == {(0, 2)} and by_id[3] == {(0, 3)}
    assert by_id[5] == by_id[6] == {(9, -9)} and by_id[None] == {(9, -9), (0, None)}
    assert jaccard.similar_groups(none).count() == 0


def test_one_of_each_group_stays(odd, none):
    kept = jaccard.one_per_group(odd)
    assert kept.columns == odd.columns
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in kept.collect())
    assert [i for missing, i, _ in ids if not missing] == [-9, 1, 2, 3, 4, 7, 8]
    assert [text for missing, _, text in ids if missing] == [""]
    assert jaccard.one_per_group(none).count() == 0


def test_repeated_rows_leave_one(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(5, text), (5, text), (9, text), (7, None), (7, None)], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in jaccard.one_per_group(docs).collect()) == [5, 7, 7]


def test_chains_of_edges_connect(spark):
    rng = random.Random(3)
    names = rng.sample(range(10**9), 300)
    edges = [(names[i], names[i + 1]) for i in range(298) if i != 149] + [(names[0], names[0])]
    got = jaccard.connected(spark.createDataFrame(edges, "a long, b long")).collect()
    place = {r["node"]: r["component"] for r in got}
    assert len({place[n] for n in names[:150]}) == len({place[n] for n in names[150:299]}) == 1
    assert place[names[0]] != place[names[200]] and names[299] not in place


def labelled(spark, n, seed):
    """Texts with three categories: rude words, threats (always rude too), and digits."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        words = [f"v{rng.randrange(900)}" for _ in range(rng.randrange(5, 60))]
        rude, digits = rng.random() < 0.3, rng.random() < 0.3
        threat = rude and rng.random() < 0.5
        words += rng.sample(["idi", "moro", "scu"], 2) if rude else []
        words += ["hurtvor"] if threat else []
        words += ["nr7"] if digits else []
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(rude), int(threat), int(digits)))
    return spark.createDataFrame(rows, "doc_id long, text string, rude int, threat int, digits int")


def test_chain_predicts_held_out_rows(spark):
    names = ("rude", "digits", "threat")
    train, test = labelled(spark, 900, 1), labelled(spark, 600, 2)
    rows = toxicity.training_rows(train.select("doc_id", "text"), train.select("doc_id", *names), names)
    chain = toxicity.fit_chain(rows, names)
    assert [len(more) for _, _, more, _ in chain.models] == [0, 1, 2]
    scored = chain.scored(test)
    for name in names:
        right = scored.where((F.col(f"p_{name}") >= 0.5) == (F.col(name) == 1)).count()
        assert right >= 0.97 * 600, name
    again = toxicity.fit_chain(rows.repartition(3), names)
    assert [m[3] for m in again.models] == [m[3] for m in chain.models]


def test_later_models_see_out_of_fold_probabilities():
    """A category equal to an earlier one that its own words cannot show is learnt from the chain."""
    rng = np.random.default_rng(0)
    n = 600
    first = rng.integers(0, 2, n).astype(float)
    features = [np.array([10 + int(x)] + list(rng.integers(100, 140, 3)), np.int32) for x in first]
    lengths = np.array([4] * n)
    models = linear.fit_chain(np.concatenate(features), lengths, np.column_stack([first, first]),
                              np.arange(n) % 3, 3)
    assert models[1][1][0] > 0.5
    found = linear.chain_probabilities(np.concatenate(features), lengths, models)
    assert ((found >= 0.5) == first[:, None].astype(bool)).mean() > 0.99


def test_training_sample_is_bounded_and_clean(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)] + [(None, "x"), (50, None)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(51)] + [(1, 0), (None, 1), (2, None)],
                                   "doc_id long, toxic int")
    rows = toxicity.training_rows(docs, labels, ("toxic",), max_rows=20)
    assert 19 <= rows.count() <= 20
    assert toxicity.training_rows(docs, labels, ("toxic",)).count() == 50


def test_chain_of_odd_tables(spark, odd, none):
    labels = spark.createDataFrame([(5, 1, 1), (4, 0, 0), (7, 1, 0)], "doc_id long, quality int, toxic int")
    chain = toxicity.chain_for(odd, labels)
    scored = chain.scored(odd)
    assert scored.count() == odd.count() and scored.columns.count("p_toxic") == 1
    assert scored.where("p_toxic is null or p_toxic < 0 or p_toxic > 1").count() == 0
    decided = scored.where("text is null or doc_id = 2").select(toxicity.is_toxic(F.col("text")).alias("t"))
    assert not any(r["t"] for r in decided.collect())
    assert chain.scored(none).count() == 0
    empty = toxicity.chain_for(none, labels.limit(0))
    assert empty.scored(odd).where("p_toxic > 0.01").count() == 0
