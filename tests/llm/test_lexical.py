"""Operator 11 against every score."""

import math
import random
import re
from collections import Counter

import numpy as np
import odd
import pytest
from oracle import connect, differences

from corpusloom.llm import lexical, queries

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(rows, items, k=10):
    held = [(i, Counter(terms(t))) for i, t in rows]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, words in asked.items():
        scored = []
        for i, c in held:
            n = sum(c.values())
            m = 100 - 90 + (90 * n * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in words if c[t]
            )
            if score > 0 and i is not None:
                scored.append((-score, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def got(spark, rows, items, k=10):
    docs = odd.documents(spark, rows).withColumnsRenamed({"hash": "terms", "ids": "counts"})
    asked = spark.createDataFrame([(i, t, "x", "y") for i, t in items], "item_id long, text string, doc_id string, term string")
    return sorted(map(tuple, lexical.search(docs, asked, k).collect()))


def corpus(seed, n=400):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" if k % 3 else f"É{k}x" for k in range(120)]
    weights = [1 / (1 + k) for k in range(120)]
    rows = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(0, 60)))) for i in range(n)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 25)))) for i in range(25)]
    # exact copies, ties, a very common text and longer texts around an item
    rows += [(n + i, rows[3][1]) for i in range(60)] + [(n + 100 + i, f"{items[0][1]} {rows[i][1]}") for i in range(40)]
    rng.shuffle(rows)
    return rows, items


@pytest.mark.parametrize("seed, cells, parts", [(1, 1 << 22, 1 << 16), (2, 4_000, 1 << 16), (3, 300, 60)])
def test_random_documents(spark, monkeypatch, seed, cells, parts):
    monkeypatch.setattr(lexical, "CHUNK_CELLS", cells)
    monkeypatch.setattr(lexical, "MAX_TERMS", parts)
    rows, items = corpus(seed)
    expected = brute(rows, items)
    assert expected and got(spark, rows, items) == expected


def test_odd_documents(spark):
    items = [(1, odd.PASSAGE), (2, None), (3, ""), (None, "one two"), (4, "alpha ALPHA beta"), (5, "漢字 é ß"), (5, "zero one"), (6, "nowhere"), (7, odd.LONG)]
    assert got(spark, odd.ROWS, items) == brute(odd.ROWS, items)
    assert got(spark, odd.ROWS, items, 2) == brute(odd.ROWS, items, 2)
    assert got(spark, [], items) == [] and got(spark, odd.ROWS, []) == []
    assert got(spark, [(1, "one"), (2, None)], [(1, "one")]) == brute([(1, "one"), (2, None)], [(1, "one")])


def test_no_bound_is_below_a_score_and_trees_prune():
    rng = np.random.default_rng(0)
    centres = rng.integers(0, 2, (20, 300)) * rng.integers(1, 10**10, (20, 300))
    y = np.where(rng.random((2000, 300)) < 0.9, centres[rng.integers(20, size=2000)], 0).astype(float)
    group = np.arange(300) * 32 // 300
    order, tree = lexical.grow(y, group)
    y = y[order]
    asked = (rng.random((50, 300)) < 0.1).astype(float)
    limit, scores = lexical.bounds(tree, asked, group), y @ asked.T
    for node, (a, b) in enumerate(zip(tree.a, tree.b)):
        assert (scores[a:b].max(0) <= limit[:, node]).all()
    assert sorted(order) == list(range(2000))
    assert sum(b - a for a, b, c in zip(tree.a, tree.b, tree.left) if c < 0) == 2000

    # the ten best of an item that one cluster answers: far from all leaves are seen
    ids, (docs, terms_) = np.arange(2000), np.nonzero(y)
    best = [lexical.Best(10) for _ in range(20)]
    queries_ = [np.flatnonzero(c > 0)[:40] for c in centres]
    seen, all_leaves = lexical.search_chunk(ids, docs, terms_, y[docs, terms_].astype(np.int64), queries_, best)
    assert seen < all_leaves / 2
    for q, held in zip(queries_, best):
        exact = y[:, q].sum(1).astype(np.int64)
        assert sorted(held.heap, reverse=True) == sorted(((int(s), -i) for i, s in enumerate(exact) if s > 0), reverse=True)[:10]


def test_query_and_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert differences(connect(sf), queries.op11_lexical(spark, sf), queries.ORACLES["op11_lexical"]) == ""
