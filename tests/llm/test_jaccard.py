"""Operator 6 against pair-by-pair components."""

import random

import brute_jaccard
import numpy as np
import odd
import pytest

from corpusloom.llm import graph, jaccard


def got(docs, k, percent):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_components(docs, k, percent).collect()}


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80), (1, 70)])
def test_random_near_copies(spark, k, percent):
    random.seed(k)
    texts, words = {}, [f"w{i}" for i in range(60)]
    for g in range(12):
        base = random.choices(words, k=random.choice([4, 20, 60, 150]))
        for _ in range(random.choice([1, 3, 9, 25])):
            copy = [w if random.random() > 0.02 else random.choice(words) for w in base]
            texts[len(texts)] = " ".join(copy + random.choices(words, k=random.choice([0, 0, 1, 4])))
    assert got(odd.documents(spark, list(texts.items())), k, percent) == brute_jaccard.components(texts, k, percent)


def test_long_lists(spark, monkeypatch):
    """Lists beyond the length, in two clusters that share most shingles."""
    monkeypatch.setattr(jaccard, "LONG_LIST", 4)
    random.seed(1)
    base = [f"w{i}" for i in range(100)]
    texts = {}
    for i in range(120):
        copy = list(base) if i % 2 else base[:80] + [f"v{j}" for j in range(20)]
        copy[random.randrange(100)] = f"x{i % 7}"
        texts[i] = " ".join(copy)
    assert got(odd.documents(spark, list(texts.items())), 3, 90) == brute_jaccard.components(texts, 3, 90)


def test_odd_documents(spark):
    found = got(odd.documents(spark, odd.ROWS), 3, 90)
    want = brute_jaccard.components({i: t for i, t in odd.ROWS if i is not None}, 3, 90)
    assert {i: v for i, v in found.items() if i is not None} == want
    rows = jaccard.near_components(odd.documents(spark, odd.ROWS), 3, 90)
    assert rows.count() == len(odd.ROWS) and rows.where("doc_id is null and component_id is not null").count() == 0
    assert jaccard.near_components(odd.empty(spark), 3, 90).count() == 0


def test_one_of_each_stays(spark):
    docs = odd.documents(spark, odd.ROWS)
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert ids == [1, 2, 3, 4, 5, 6, 9, 10, 11, 12] and kept.where("doc_id is null").count() == 2


def test_divide_skip_counts():
    rng = np.random.default_rng(0)
    query = np.unique(rng.integers(0, 300, 120).astype(np.uint64))
    sets = [np.unique(rng.integers(0, 300, n).astype(np.uint64)) for n in (5, 60, 120, 200, 290)] + [query]
    need = np.array([2, 20, 40, 70, 100, len(query)])
    real = np.array([len(np.intersect1d(query, s)) for s in sets])
    assert (jaccard.overlaps(query, sets, need) == np.where(real >= need, real, 0)).all()


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)], "a long, b long")
    found = {r["node"]: r["component"] for r in graph.components(links).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 90, 90: 90, 95: 90}
    assert graph.components(links.where("a < 0")).count() == 0


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80)])
def test_short_texts_with_a_few_words_added(spark, k, percent):
    """One set inside the other, and no third text like them: what only one of them lists the other may hold."""
    texts = {}
    for n in range(6, 41):
        for _ in range(6):
            at = len(texts)
            base = [f"p{at}w{j}" for j in range(n + k - 1)]
            added = [f"p{at}x{j}" for j in range(n * (100 - percent) // percent)]
            texts[at] = " ".join(base)
            texts[at + 1] = " ".join(base + added if at % 4 else added + base)
    want = brute_jaccard.components(texts, k, percent)
    assert sum(c != i for i, (_, c) in want.items()) == 35 * 6
    assert got(odd.documents(spark, list(texts.items())), k, percent) == want


def test_near_copies_behind_unlike_heads(spark, monkeypatch):
    """The first set of each list is a short text unlike the copies: these are still not compared each with each."""
    compared, across = [], jaccard._across
    monkeypatch.setattr(jaccard, "_across", lambda *args: compared.append(across(*args).count()) or across(*args))
    random.seed(2)
    base = [f"w{i}" for i in range(200)]
    texts = {i: " ".join(base[i : i + 12]) for i in range(189)}
    for i in range(60):
        copy = list(base)
        copy[random.randrange(200)] = f"x{i}"
        texts[1000 + i] = " ".join(copy)
    assert got(odd.documents(spark, list(texts.items())), 3, 90) == brute_jaccard.components(texts, 3, 90)
    assert sum(compared) < 60, compared
