"""Operator 8 against all inner products."""

import numpy as np
import pytest
from oracle import connect, differences

from corpusloom.llm import queries, voronoi

SCHEMA = "vec_id long, embedding array<float>, score string, v string, group string"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, "x", "y", "z") for i, e in rows], SCHEMA).repartition(3)


def brute(rows, k, every):
    usable = {}
    for i, e in rows:
        if i is not None and e and all(x is not None and np.isfinite(x) for x in e):
            usable.setdefault((i, tuple(int(np.floor(64 * float(np.float32(x)))) for x in e)))
    out = []
    for i, q in usable:
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in usable if j != i and len(v) == len(q))
            out += [(i, r, j, -s) for r, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("spread, n", [(0.05, 900), (1.0, 300)])
def test_clusters_ties_and_blocks(spark, monkeypatch, spread, n):
    monkeypatch.setattr(voronoi, "BLOCK_ROWS", 200)
    monkeypatch.setattr(voronoi, "QUERY_ROWS", 10)
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + spread * rng.normal(size=8)).tolist()) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(200)]  # one very common vector
    got = sorted(map(tuple, voronoi.knn_join(frame(spark, rows), 5, 20, 6).collect()))
    assert got == brute(rows, 5, 20)


def test_needless_vectors_stay(spark):
    """Far clusters are not sent to each other's queries."""
    rng = np.random.default_rng(0)
    rows = [(i, (10 * np.eye(6)[i % 6] + 0.01 * rng.normal(size=6)).tolist()) for i in range(600)]
    whole = voronoi.whole_vectors(frame(spark, rows))
    centres = voronoi.pivots_of(voronoi.matrix(whole.toArrow().column("v")), 6)
    grouped = voronoi._grouped(whole, centres)
    data, asked = voronoi._summary(grouped, 6), voronoi._summary(grouped.where("vec_id % 20 = 0"), 0)
    sent = voronoi._needed(grouped, centres, asked, voronoi._sure_scores(centres, data, asked, 5)).count()
    assert 100 * len(asked) <= sent < 150 * len(asked)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (20, [0.5, -1.0]), (40, None), (60, []), (80, [nan, 1.0]), (1, [inf, 1.0]), (2, [None, 1.0]),
            (None, [1.0, 1.0]), (3, [1.0, 2.0]), (4, [1.0, 2.0]), (4, [1.0, 2.0]), (5, [-0.001, 0.0])]
    assert sorted(map(tuple, voronoi.knn_join(frame(spark, rows)).collect())) == brute(rows, 20, 20)
    assert voronoi.knn_join(frame(spark, [])).count() == 0
    assert voronoi.knn_join(frame(spark, [(1, [1.0])])).count() == 0
    assert voronoi.knn_join(frame(spark, [(0, [1.0])])).count() == 0


def test_each_length_by_itself(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=2 + i % 3).tolist()) for i in range(90)] + [(120, [1.0] * 7), (20, [0.5, 0.5, 0.5])]
    got = sorted(map(tuple, voronoi.knn_join(frame(spark, rows), 5, 20, 4).collect()))
    assert got == brute(rows, 5, 20) and {r[0] for r in got} == {0, 20, 40, 60, 80}


def test_query_and_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert differences(connect(sf), queries.op8_voronoi(spark, sf), queries.ORACLES["op8_voronoi"]) == ""
