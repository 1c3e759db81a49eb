"""Operator 12 against all pairs."""

import random

import numpy as np
import pytest
from oracle import connect, differences

from corpusloom.llm import negatives, queries

SCHEMA = "vec_id long, embedding array<float>, label int, score string, v string, anchor string, chunk string"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, c, "x", "y", "z", "w") for i, e, c in rows], SCHEMA).repartition(3)


def brute(rows, every=50):
    kept = set()
    for i, e, c in rows:
        if i is not None and c is not None and e is not None and all(x is not None and np.isfinite(x) for x in e):
            c = (c + 1) % 10 if i % 7 == 0 else c
            kept.add((i, c, tuple(int(np.floor(256 * float(np.float32(x)))) for x in e)))
    out = []
    for i, c, q in kept:
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j, d) for j, d, v in kept if j != i and len(v) == len(q))
            same = [(-s, j) for s, j, d in scored if d == c][:5]
            other = [(-s, j) for s, j, d in scored if d != c]
            for ps, p in same:
                fits = [(s, j) for s, j in other if 50 * ps <= 100 * s <= 95 * ps][:3]
                out += [(i, p, r, j, ps, s) for r, (s, j) in enumerate(fits, 1)]
    return sorted(out)


def got(spark, rows, every=50):
    return sorted(map(tuple, negatives.mine(frame(spark, rows), every).collect()))


@pytest.mark.parametrize("dims, n", [(6, 900), (2, 400)])
def test_blocks_ties_and_a_common_vector(spark, monkeypatch, dims, n):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 150)
    monkeypatch.setattr(negatives, "CHUNK_ROWS", 7)
    monkeypatch.setattr(negatives, "STRIP_SCORES", 500)
    rng = np.random.default_rng(dims)
    rows = [(i, (rng.integers(-4, 5, dims) / 16).tolist(), int(rng.integers(3))) for i in range(n)]
    rows += [(n + i, rows[1][1], int(rng.integers(3))) for i in range(300)]
    expected = brute(rows, 10)
    assert expected and got(spark, rows, 10) == expected


def test_zero_and_negative_scores(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [-1.0, 0.0], 1), (9, [0.0, 2.0], 2), (3, [0.0, -1.0], 2), (4, [0.0, 5.0], 2),
            (5, [0.0, 7.0], 2), (6, [-0.7, 0.0], 2), (100, [0.0, 0.0], 2), (50, [0.5, 0.5], 2)]
    expected = brute(rows)
    assert any(r[4] == 0 for r in expected)
    assert got(spark, rows) == expected


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 3), (0, [1.0, 2.0], 3), (0, [2.0, 2.0], 3), (50, None, 1), (100, [nan, 1.0], 1), (150, [1.0, 1.0], None), (200, [], 1),
            (None, [1.0, 1.0], 1), (1, [inf, 1.0], 3), (2, [None, 1.0], 3), (3, [1.0, 2.0], 4), (4, [1.0, 1.0], 4), (4, [1.0, 1.0], 4),
            (5, [0.9, 1.2], 5), (6, [1.0, 1.0, 1.0], 3), (8, [1.5, 1.5], 4), (15, [], 2), (250, [3.0], 4), (7, [-0.001, 0.0], 2)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []
    assert got(spark, [(0, [1.0], 1)]) == []
    assert got(spark, [(1, [1.0], 1)]) == []


def test_large_components_stay_exact(spark):
    rng = random.Random(1)
    rows = [(i, [float(rng.randrange(1, 1 << 20)) for _ in range(3)], i % 3) for i in range(120)]
    assert max(r[5] for r in brute(rows, 10)) > 2**53
    assert got(spark, rows, 10) == brute(rows, 10)


def test_keys_sort_like_their_numbers():
    rng = random.Random(0)
    values = [-(2**63), -1, 0, 1, 2**63 - 1]
    keys = [tuple(rng.choice(values) for _ in range(4)) for _ in range(200)]
    assert [negatives.unpack(negatives.pack(*k)) for k in keys] == keys
    assert sorted(keys, key=lambda k: negatives.pack(*k)) == sorted(keys, key=lambda k: (k[0], k[1], -k[2], k[3]))


def test_the_iterator_holds_no_anchor(spark):
    """A hundred thousand negatives of one anchor pass; the windows are all that is kept."""
    def pairs():
        for i in range(5):
            yield negatives.pack(0, 1, 10**6 - i, i), True
        for i in range(100_000):
            yield negatives.pack(0, 1, 900_000 - i, 100 + i), False

    out = list(negatives.windows_of(pairs(), 3, 50, 95))
    assert len(out) == 15 and {r[3] for r in out} == {100, 101, 102}


def test_query_and_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert differences(connect(sf), queries.op12_negatives(spark, sf), queries.ORACLES["op12_negatives"]) == ""
