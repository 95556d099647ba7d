"""Spelling variants against brute force."""

import collections
import random
import re
import zlib

import pytest

from caseloom.llm import spelling


def brute_words(docs, least_length, least_count):
    sums = collections.Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            sums[run] += 1
    return {w: n for w, n in sums.items() if len(w) >= least_length and n >= least_count}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_pairs(words):
    names = sorted(words)
    return {(a, b) for k, a in enumerate(names) for b in names[k + 1:] if near(a, b)}


def brute_groups(words, times=2):
    found = collections.defaultdict(list)
    for a, b in brute_pairs(words):
        found[a].append((-words[b], b))
        found[b].append((-words[a], a))
    form = {w: min(others) for w, others in found.items() if -min(others)[0] >= times * words[w]}
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root][1]
        best = form.get(w)
        out.add((w, n, len(found[w]), best and best[1], best and -best[0], root))
    return out


def some_words(seed, n, letters="abcé", lengths=(1, 9)):
    rnd = random.Random(seed)
    return {"".join(rnd.choice(letters) for _ in range(rnd.randint(*lengths))): rnd.choice([1, 2, 3, 5, 8, 20, 90])
            for _ in range(n)}


@pytest.mark.parametrize("most_compared", [20_000, 4, 0])
@pytest.mark.parametrize("words", [some_words(1, 400), some_words(2, 300, "ab", (5, 6)),
                                   {"prefix" + w: n for w, n in some_words(3, 300, "abcdefgh", (1, 4)).items()}])
def test_pairs_equal_brute_force(spark, words, most_compared):
    rows = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    got = [(min(r["a"], r["b"]), max(r["a"], r["b"]), words[r["a"]] == r["n_a"] and words[r["b"]] == r["n_b"])
           for r in spelling.near_pairs(rows, most_compared).collect()]
    assert len(got) == len({g[:2] for g in got}) and all(g[2] for g in got)
    assert {g[:2] for g in got} == brute_pairs(words)


def test_groups_equal_brute_force(spark):
    rnd = random.Random(4)
    names = list(some_words(5, 60, "abcdé", (4, 7)))
    docs = [(i, " ".join(rnd.choice(names[: 1 + i % 60]).title() + "," for _ in range(400))) for i in range(60)]
    docs += [(None, "Gauß gauss GAUSS gaus gauss x"), (70, None), (71, ""), (72, "ÀÉÎÕÜ àéîõü"), (72, "ÀÉÎÕÜ àéîõü"),
             (80, "chainw " * 3 + "chainwo " * 9 + "chainwor " * 40)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {tuple(r) for r in spelling.variant_groups(table, 4, 2).select(
        "word", "n", "n_near", "form", "form_n", "root").collect()}
    want = brute_groups(brute_words(docs, 4, 2))
    assert got == want and any(w[5] not in (w[0], w[3]) for w in want)


def test_long_chain_of_forms(spark):
    names = ["a" * 5 + "b" * k for k in range(9)]
    words = {w: 3 ** (k + 1) for k, w in enumerate(names)}
    rows = spark.createDataFrame(list(words.items()), "word string, n long")
    got = spelling.rooted(spelling.spelling_forms(rows, spelling.near_pairs(rows)))
    assert {r["root"] for r in got.collect()} == {names[-1]}


def test_hot_chunks_and_long_words(spark):
    long = "x" * 3_000
    words = {**{f"common{a}{b}{c}": 3 for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"},
             long: 3, long + "y": 9, "x" * 1_400 + "z" + "x" * 1_599: 4}
    rows = spark.createDataFrame(list(words.items()), "word string, n long")
    pairs = spelling.near_pairs(rows, 50)
    assert pairs.count() == 512 * 21 // 2 + 2


def test_odd_and_empty_tables(odd, none):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = {tuple(r) for r in spelling.variant_groups(odd, 3, 1).select(
        "word", "n", "n_near", "form", "form_n", "root").collect()}
    assert got == brute_groups(brute_words(docs, 3, 1))
    assert spelling.variant_groups(none).collect() == []
