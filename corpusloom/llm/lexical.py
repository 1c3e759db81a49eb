"""Operator 11: exact ranked lexical search by sparse ball trees over inner products.

A document is a sparse vector over the words of the items: of each word w times
its impact, both whole numbers. In this space an item is the indicator of its
words, and the score is their inner product. Documents are indexed where they
lie: each task gathers them in chunks and splits every chunk into a ball tree,
whose nodes keep a centroid c and, for each of BLOCKS groups of words, the
radius r of the documents around it. No document under a node scores more than

    sum over the item's words of c  +  sum over groups of sqrt(words of the item in the group) * r

(Cauchy and Schwarz, group by group). Both terms are rounded up by far more than
doubles can be off. An item walks a tree best-first, from the node with the
highest bound, and stops at the first bound below the k-th best score that the
task has seen so far; at the leaves scores are summed as whole numbers. The k
best of every task are ranked at the end.

Words are compared by 64-bit hashes of whole words. Items are worked on in parts
of about MAX_TERMS words, each with a pass over the documents of its own, so the
tables that every task holds stay small however large the benchmark is.

Defined results. A null or empty text has no words; such an item has no result and
such a document does not count. Documents without an id count in the statistics,
but are not ranked; repeated rows are ranked one by one. Rows with the same item id
are one item with the words of all of them; a null item id is left out. Ties go to
the smaller doc_id. Other columns are not looked at.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.texts import WORD_BYTES, flat, map_texts, record, words
from corpusloom.session import stage, work_dir

K = 10
# Words of all items of one part, about.
MAX_TERMS = 65_536
# Numbers that a chunk of documents holds at most as a matrix; one document is a chunk at least.
CHUNK_CELLS = 1 << 22
LEAF_ROWS, BLOCKS = 24, 1024
# More than all rounding of a bound: sums of n doubles are off by less than n * 2^-53 of their size.
SLACK = 1e-7

# The scoring rule.
WEIGHT_SCALE, LENGTH_BASE, LENGTH_SHARE, IMPACT_SCALE, TF_SHARE, LENGTH_WEIGHT = 1000, 100, 90, 1_000_000_000, 1000, 8

RESULT = "item_id long, rank int, doc_id long, score long"


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item with a score above 0."""
    spark = docs.sparkSession
    asked = stage(item_terms(items), work_dir(spark, "lexical-items"))
    parts = 1 + asked.count() // MAX_TERMS
    part = F.pmod(F.xxhash64("item_id"), F.lit(parts))
    results = [_search(docs, asked.where(part == p), k) for p in range(parts)]
    results = [r for r in results if r is not None]
    return reduce(DataFrame.unionByName, results) if results else spark.createDataFrame([], RESULT)


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term): the hashes of each item's distinct words."""
    texts = items.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("long").alias("doc_id"), "text")
    schema = pa.schema([("item_id", pa.int64()), ("term", pa.int64())])

    def work(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        w = words(*flat(part.column("text")), WORD_BYTES)
        ids = part.column("doc_id").to_numpy()[w.doc]
        yield record(schema, ids, w.hash.view(np.int64))

    return map_texts(texts, work, "item_id long, term long").distinct()


def _search(docs: DataFrame, asked: DataFrame, k: int) -> DataFrame | None:
    pairs = asked.toArrow()
    if not pairs.num_rows:
        return None
    terms = np.unique(pairs.column("term").to_numpy().view(np.uint64))
    rows = stage(term_counts(docs, terms), work_dir(docs.sparkSession, "lexical-counts"))
    n_docs, n_terms = (int(x or 0) for x in rows.agg(F.count(F.lit(1)), F.sum("n")).first())
    df = np.zeros(len(terms), np.int64)
    for place, n in rows.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # one row per term at most
        df[place] = n
    weights = np.array([weight(n_docs, int(n)) if n else 0 for n in df], np.int64)

    place = np.searchsorted(terms, pairs.column("term").to_numpy().view(np.uint64))
    ids, item = np.unique(pairs.column("item_id").to_numpy(), return_inverse=True)
    useful = weights[place] > 0
    queries = [np.sort(place[useful & (item == i)]) for i in range(len(ids))]
    best = rows.where(F.col("doc_id").isNotNull()).mapInArrow(
        _searcher(ids.tolist(), queries, weights, n_docs, n_terms, k), "item_id long, doc_id long, score long"
    )
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def weight(n_docs: int, df: int) -> int:
    return math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


def term_counts(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, counts) of every document with a word: all its words, and which of ``terms`` it holds how often."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))]
    )

    def work(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        w = words(*flat(part.column("text")), WORD_BYTES)
        n = np.bincount(w.doc, minlength=part.num_rows)
        at = np.minimum(np.searchsorted(terms, w.hash), len(terms) - 1)
        hit = terms[at] == w.hash
        found, counts = np.unique(w.doc[hit] * len(terms) + at[hit], return_counts=True)
        doc, term = np.divmod(found, len(terms))
        begin = np.searchsorted(doc, np.arange(part.num_rows + 1)).astype(np.int32)
        batch = record(
            schema, part.column("doc_id"), n,
            pa.ListArray.from_arrays(pa.array(begin), pa.array(term.astype(np.int32))),
            pa.ListArray.from_arrays(pa.array(begin), pa.array(counts.astype(np.int64))),
        )
        yield batch.filter(pa.array(n > 0))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_texts(rows, work, "doc_id long, n long, terms array<int>, counts array<long>")


def impacts(n: int, counts: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Of one document of ``n`` words: the impact of each word it holds ``counts`` times."""
    m = LENGTH_BASE - LENGTH_SHARE + (LENGTH_SHARE * n * n_docs) // n_terms
    return (IMPACT_SCALE * counts) // (TF_SHARE * counts + LENGTH_WEIGHT * m)


@dataclass
class Tree:
    """Nodes in order of making: the rows [a, b) below, the children or -1, centroid and radii."""

    a: list[int]
    b: list[int]
    left: list[int]
    right: list[int]
    centre: np.ndarray
    radius: np.ndarray


def grow(y: np.ndarray, group: np.ndarray, leaf: int = LEAF_ROWS) -> tuple[np.ndarray, Tree]:
    """The order of the rows of ``y`` that makes every node a range of rows, and the tree."""
    order, square = np.arange(len(y)), (y**2).sum(1)
    a, b, left, right, todo = [0], [len(y)], [-1], [-1], [0]
    while todo:
        node = todo.pop()
        mine = order[a[node] : b[node]]
        if len(mine) <= leaf:
            continue
        far = mine[_from(y, square, mine, mine[0]).argmax()]
        one = _from(y, square, mine, far)
        two = _from(y, square, mine, mine[one.argmax()])
        near = one < two
        if near.all() or not near.any():  # all alike: halves are as good as any
            near = np.arange(len(mine)) < len(mine) // 2
        order[a[node] : b[node]] = np.concatenate([mine[near], mine[~near]])
        cut = a[node] + int(near.sum())
        for children, low, high in ((left, a[node], cut), (right, cut, b[node])):
            children[node] = len(a)
            todo.append(len(a))
            a.append(low)
            b.append(high)
            left.append(-1)
            right.append(-1)
    y = y[order]
    starts = np.searchsorted(group, np.arange(group.max(initial=0) + 1))
    centre, radius = np.empty((len(a), y.shape[1])), np.empty((len(a), len(starts)))
    for node in range(len(a)):
        rows = y[a[node] : b[node]]
        centre[node] = rows.mean(0)
        radius[node] = np.sqrt(np.add.reduceat((rows - centre[node]) ** 2, starts, axis=1).max(0))
    return order, Tree(a, b, left, right, centre, radius)


def _from(y: np.ndarray, square: np.ndarray, rows: np.ndarray, one: int) -> np.ndarray:
    """Squared distances of some rows from one, near enough to choose sides by."""
    return square[rows] - 2 * (y[rows] @ y[one]) + square[one]


def bounds(tree: Tree, asked: np.ndarray, group: np.ndarray) -> np.ndarray:
    """(queries, nodes): no row below the node has a larger inner product with the indicator in ``asked``."""
    starts = np.searchsorted(group, np.arange(group.max(initial=0) + 1))
    inside = np.sqrt(np.add.reduceat(asked, starts, axis=1))
    return (asked @ tree.centre.T + inside @ tree.radius.T) * (1 + SLACK) + SLACK


def best_first(tree: Tree, bound: np.ndarray, least: int | None, visit) -> int:
    """Give ``visit`` the leaves from the highest bound down; it returns the score to reach. Leaves seen."""
    heap, seen = [(-bound[0], 0)], 0
    while heap:
        high, node = heapq.heappop(heap)
        if least is not None and -high < least:
            break
        if tree.left[node] < 0:
            seen += 1
            least = visit(tree.a[node], tree.b[node])
        else:
            for child in (tree.left[node], tree.right[node]):
                if least is None or bound[child] >= least:
                    heapq.heappush(heap, (-bound[child], child))
    return seen


class Best:
    """The k best (score, -doc_id) of one item so far."""

    def __init__(self, k: int):
        self.k, self.heap = k, []

    def least(self) -> int | None:
        """A score below this one can't enter; None while any above 0 can."""
        return self.heap[0][0] if len(self.heap) == self.k else None

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        edge = self.least() or 1
        if scores.max() < edge:
            return
        for j in np.flatnonzero(scores >= edge):
            entry = (int(scores[j]), -int(ids[j]))
            if len(self.heap) < self.k:
                heapq.heappush(self.heap, entry)
            elif entry > self.heap[0]:
                heapq.heapreplace(self.heap, entry)


def search_chunk(ids: np.ndarray, docs: np.ndarray, terms: np.ndarray, values: np.ndarray, queries: list[np.ndarray], best: list[Best]) -> tuple[int, int]:
    """All queries over the documents of one chunk; (leaves seen, leaves there were).

    ``docs``, ``terms`` and ``values`` are the entries of the chunk's matrix.
    """
    columns, column = np.unique(terms, return_inverse=True)
    # groups of words are alike in size, each a range of columns
    mixed = np.argsort((columns.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32), kind="stable")
    place = np.empty(len(columns), np.int64)
    place[mixed] = np.arange(len(columns))
    group = np.arange(len(columns)) * min(BLOCKS, len(columns)) // len(columns)
    y = np.zeros((len(ids), len(columns)))
    y[docs, place[column]] = values
    order, tree = grow(y, group)
    y, ids = y[order], ids[order]

    asked, mine = np.zeros((len(queries), len(columns))), []
    for i, q in enumerate(queries):
        at = np.searchsorted(columns, q)
        at = at[(at < len(columns)) & (columns[np.minimum(at, len(columns) - 1)] == q)]
        mine.append(np.sort(place[at]))
        asked[i, mine[-1]] = 1
    # whole numbers: sums of doubles are exact below 2^53
    exact = y if y.max(initial=0) * max(1, len(columns)) < 2.0**53 else y.astype(np.int64)
    limit, seen = bounds(tree, asked, group), 0
    for i, held in enumerate(best):
        if len(mine[i]):
            def visit(a: int, b: int) -> int | None:
                held.add(exact[a:b, mine[i]].sum(1).astype(np.int64), ids[a:b])
                return held.least()

            seen += best_first(tree, limit[i], held.least(), visit)
    return seen, len(queries) * sum(c < 0 for c in tree.left)


def _searcher(item_ids: list[int], queries: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, k: int):
    schema = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        ids, entries, seen = [], [], set()
        for batch in batches:
            doc_ids, ns = batch.column("doc_id").to_pylist(), batch.column("n").to_pylist()
            begin = batch.column("terms").offsets.to_numpy()
            begin, base = begin - begin[0], begin[0]
            terms = batch.column("terms").flatten().to_numpy().astype(np.int64)
            counts = batch.column("counts").flatten().to_numpy()
            for j, doc_id in enumerate(doc_ids):
                mine = slice(begin[j], begin[j + 1])
                value = impacts(ns[j], counts[mine], n_docs, n_terms) * weights[terms[mine]]
                own = terms[mine][value > 0]
                if not len(own):
                    continue
                more = seen.union(own.tolist())
                if ids and (len(ids) + 1) * len(more) > CHUNK_CELLS:
                    yield ids, entries
                    ids, entries, more = [], [], set(own.tolist())
                ids.append(doc_id)
                entries.append((own, value[value > 0]))
                seen = more
        if ids:
            yield ids, entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in queries]
        for ids, entries in chunks(batches):
            sizes = [len(e[0]) for e in entries]
            search_chunk(
                np.array(ids), np.repeat(np.arange(len(ids)), sizes), np.concatenate([e[0] for e in entries]),
                np.concatenate([e[1] for e in entries]), queries, best,
            )
        found = [(i, -d, s) for i, held in zip(item_ids, best) for s, d in held.heap]
        if found:
            yield record(schema, *map(list, zip(*found)))

    return run
