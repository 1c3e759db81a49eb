"""Operator 8: exact top-k search as a Voronoi kNN join on inner products.

A bounded sample of vectors gives the pivots; every vector belongs to its
nearest one. Each group is summed up by its radius, its longest vector and the
distances of its K innermost vectors. From these alone follows, for every
group of queries, a score that K candidates of each of its queries are sure to
reach. A data vector is sent to a query group only if the group's centre c and
radius s allow it that score: q.v <= c.v + s |v|. Each pair of a query group and
a block of data is solved on its own with whole-number products, and the best K
of each query's blocks are its result. Blocks of rows, not groups, bound a task, so
a group of a third of all rows is spread like any other.

Vectors that are null, empty or hold a null or non-finite component take no
part, nor do rows without an id. Vectors of different lengths have no inner
product: each length is joined by itself, one after the other, so a query's
candidates are the vectors of its own length. Rows equal in id and vector count once; rows of the query's own id
are no candidates. Ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import stage, work_dir

K = 20
PIVOTS = 24
# Vectors the pivots are chosen from at most.
SAMPLE_ROWS = 4_096
# Data vectors and queries that one local problem holds at most, on average.
BLOCK_ROWS, QUERY_ROWS = 16_384, 1_024

RESULT = "query_id long, rank int, vec_id long, score long"


def whole_vectors(vectors: DataFrame, scale: float = 64.0) -> DataFrame:
    """(vec_id, v): components as floor(scale * x), one row per distinct id and vector."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~bad
    scaled = F.transform(x, lambda c: F.floor(c * scale).cast("long"))
    return vectors.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("v")).distinct()


def matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def pivots_of(sample: np.ndarray, n: int) -> np.ndarray:
    """Pivots far from each other: each next one is the sample vector farthest from those chosen."""
    chosen = [0]
    near = ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < min(n, len(sample)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    centres = sample[chosen]
    for _ in range(4):  # towards the middle of their groups
        owner = nearest(sample, centres)[0]
        centres = np.stack([sample[owner == g].mean(0) if (owner == g).any() else centres[g] for g in range(len(centres))])
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    square = (x**2).sum(1)[:, None] - 2 * x @ centres.T + (centres**2).sum(1)
    owner = square.argmin(1)
    # once more, by the difference itself: no digits are lost
    return owner, np.sqrt(((x - centres[owner]) ** 2).sum(1))


def knn_join(vectors: DataFrame, k: int = K, every: int = 20, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each id divisible by ``every`` its k best other vectors."""
    spark = vectors.sparkSession
    rows = stage(whole_vectors(vectors), work_dir(spark, "vectors"))
    found = spark.createDataFrame([], RESULT)
    # a row per length of vectors, as a rule one
    lengths = sorted(r["n"] for r in rows.select(F.size("v").alias("n")).distinct().collect())
    for n in lengths:
        one = _join_of_one_length(rows.where(F.size("v") == n), k, every, pivots)
        found = one if len(lengths) == 1 else found.unionByName(one)
    return found


def _join_of_one_length(rows: DataFrame, k: int, every: int, pivots: int) -> DataFrame:
    spark = rows.sparkSession
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(SAMPLE_ROWS).toArrow()
    centres = pivots_of(matrix(sample.column("v")), pivots)

    grouped = stage(_grouped(rows, centres), work_dir(spark, "groups"))
    queries = grouped.where(F.col("vec_id") % every == 0)
    data, asked = _summary(grouped, k + 1), _summary(queries, 0)
    if not asked:
        return spark.createDataFrame([], RESULT)
    sure = _sure_scores(centres, data, asked, k)
    n_data, n_queries = sum(s["n"] for s in data.values()), sum(s["n"] for s in asked.values())
    blocks, chunks = 1 + n_data // BLOCK_ROWS, 1 + n_queries // QUERY_ROWS // max(1, len(asked))

    keyed = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block")
    sent = _needed(grouped, centres, asked, sure).select("group", keyed, "vec_id", "v")
    # a group's queries stand against every block of data, in chunks
    mine = F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(chunks)).cast("int").alias("chunk")
    spread = queries.select("group", mine, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "vec_id", "v")
    sent = sent.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    local = (
        spread.groupBy("group", "block", "chunk")
        .cogroup(sent.groupBy("group", "block", "chunk"))
        .applyInArrow(_solve(k), "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = local.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _grouped(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    names = ["vec_id", "v", "group", "far", "length"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("v"))
                owner, far = nearest(x, centres)
                extra = [pa.array(owner.astype(np.int32)), pa.array(far), pa.array(np.sqrt((x**2).sum(1)))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=names)

    return rows.mapInArrow(work, "vec_id long, v array<long>, group int, far double, length double")


def _summary(grouped: DataFrame, k: int) -> dict[int, dict]:
    """Of each group: rows, radius, longest vector and the k smallest distances; as many rows as pivots."""
    plain = grouped.groupBy("group").agg(
        F.count(F.lit(1)).alias("n"), F.max("far").alias("radius"), F.max("length").alias("length")
    )
    found = {r["group"]: r.asDict() | {"inner": []} for r in plain.collect()}
    if k:
        # a limit on the row number is applied before the shuffle too: k rows of a group from each task
        order = Window.partitionBy("group").orderBy("far")
        inner = grouped.select("group", "far").withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)
        for r in inner.groupBy("group").agg(F.sort_array(F.collect_list("far")).alias("far")).collect():
            found[r["group"]]["inner"] = r["far"]
    return found


def _sure_scores(centres: np.ndarray, data: dict, asked: dict, k: int) -> dict[int, float]:
    """For each group of queries: a score that k vectors besides the query itself reach for all its queries."""
    sure = {}
    for g, q in asked.items():
        reached = []
        for j, d in data.items():
            at_pivot = centres[g] @ centres[j] - q["radius"] * np.linalg.norm(centres[j])
            reached += [at_pivot - q["length"] * far for far in d["inner"]]
        reached.sort(reverse=True)
        # one of them may be the query itself
        sure[g] = reached[k] - 1e-6 * (1 + abs(reached[k])) if len(reached) > k else -np.inf
    return sure


def _needed(grouped: DataFrame, centres: np.ndarray, asked: dict, sure: dict) -> DataFrame:
    """Each vector once for every query group whose sure score it may reach."""
    groups = sorted(asked)
    c, s = centres[groups], np.array([asked[g]["radius"] for g in groups])
    least = np.array([sure[g] for g in groups])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("v"))
            bound = x @ c.T + np.sqrt((x**2).sum(1))[:, None] * s
            row, group = np.nonzero(bound * (1 + 1e-9 * np.sign(bound)) + 1e-6 >= least)
            names = pa.array(np.array(groups, np.int32)[group])
            taken = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([names, *taken.columns], names=["group", "vec_id", "v"])

    return grouped.select("vec_id", "v").mapInArrow(work, "group int, vec_id long, v array<long>")


def _solve(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def solve(asked: pa.Table, data: pa.Table) -> pa.Table:
        if not asked.num_rows or not data.num_rows:
            return schema.empty_table()
        ids, names = data.column("vec_id").to_numpy(), asked.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        x, q, ids = matrix(data.column("v"))[order], matrix(asked.column("v")), ids[order]
        # doubles are exact below 2^53; longer products are taken as whole numbers
        if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * x.shape[1] >= 2.0**53:
            x, q = x.astype(np.int64), q.astype(np.int64)
        out = []
        for a in range(0, len(q), 64):
            scores = (q[a : a + 64] @ x.T).astype(np.int64)
            for name, row in zip(names[a : a + 64].tolist(), scores):
                other = ids != name
                mine, near = row[other], ids[other]
                if len(mine) > k:
                    # all above the k-th score and, of its ties, the smallest ids
                    edge = np.partition(mine, len(mine) - k)[len(mine) - k]
                    top = np.flatnonzero(mine > edge)
                    top = np.concatenate([top, np.flatnonzero(mine == edge)[: k - len(top)]])
                    mine, near = mine[top], near[top]
                out.append((np.full(len(mine), name), near, mine))
        return pa.table([np.concatenate(c) for c in zip(*out)], schema=schema)

    return solve
