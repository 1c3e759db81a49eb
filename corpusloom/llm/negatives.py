"""Operator 12: hard negatives by a secondary-sort shuffle over scored pairs.

Every anchor meets every row, in cells of a block of rows and a chunk of
anchors, as whole-number products. The first round keeps of each cell an
anchor's best rows of its own label; the best of all cells are its positives,
and their scores s open the windows [low * s, high * s]. The second round
keeps of each cell the first negatives inside each window. So a cell lends an
anchor a fixed number of pairs, however many rows and ties it holds.

Positives and negatives are packed into one binary key: anchor, falling score,
id. ``repartitionAndSortWithinPartitions`` deals them out by anchor and sorts
them by the whole key. The iterator behind it sees an anchor's pairs from the
highest score down, so each positive comes before all that its window holds:
it opens a window per positive, counts the negatives that fall in and gives
them out at once. It never holds more than the open windows of one anchor.

Defined results. Rows with a null id, label or vector, or with a null or
non-finite component take no part. Rows alike in id, label and vector count
once; rows that share an id only are rows of their own, but none is a candidate
of its own id. Vectors of different lengths are never compared. Scores are
64-bit integers. A positive with a score below zero has no window. Ties go to
the smaller id. Other columns are not looked at.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import stage, work_dir

POSITIVES, NEGATIVES = 5, 3
# The window, in hundredths of the positive's score.
LOW, HIGH = 50, 95
# Rows and anchors of one cell, on average.
BLOCK_ROWS, CHUNK_ROWS = 16_384, 1_024
# Scores held at a time while a cell is worked on.
STRIP_SCORES = 1 << 20

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_PAIR = "anchor long, vec_id long, score long, positive boolean"


def mine(
    vectors: DataFrame, every: int = 50, moved: int = 7, labels: int = 10, scale: float = 256.0,
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
) -> DataFrame:
    """The first ``negatives`` inside the window of each positive of each anchor; see RESULT.

    Anchors are the rows whose id is divisible by ``every``; rows whose id is
    divisible by ``moved`` move to the next of ``labels`` labels first.
    """
    spark = vectors.sparkSession
    rows = stage(_rows(vectors, moved, labels, scale), work_dir(spark, "negatives-rows"))
    anchors = rows.where(F.col("vec_id") % every == 0)
    blocks = 1 + rows.count() // BLOCK_ROWS
    chunks = 1 + anchors.count() // CHUNK_ROWS

    found = _cells(rows, anchors.withColumn("scores", F.array().cast("array<long>")), blocks, chunks, _own_label(positives))
    first = Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id", "row")
    best = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= positives)
    best = stage(best.select("anchor", "vec_id", "score"), work_dir(spark, "negatives-positives"))

    windows = best.groupBy(F.col("anchor").alias("row")).agg(F.collect_set("score").alias("scores"))
    asked = anchors.join(windows, "row")
    others = _cells(rows, asked, blocks, chunks, _other_labels(negatives, low, high))
    pairs = best.select("anchor", "vec_id", "score", F.lit(True).alias("positive")).unionByName(
        others.select("anchor", "vec_id", "score", F.lit(False).alias("positive"))
    )
    names = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return _sorted_windows(pairs.join(names, "anchor"), negatives, low, high)


def _rows(vectors: DataFrame, moved: int, labels: int, scale: float) -> DataFrame:
    """(row, vec_id, label, v, n): ``row`` tells rows of one id apart."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    known = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % moved == 0, (label + 1) % labels).otherwise(label)
    scaled = F.transform(x, lambda c: F.floor(c * scale).cast("long"))
    rows = vectors.where(known).select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), scaled.alias("v")).distinct()
    return rows.select(F.xxhash64("vec_id", "label", "v").alias("row"), "vec_id", "label", "v", F.size("v").alias("n"))


def _cells(rows: DataFrame, anchors: DataFrame, blocks: int, chunks: int, keep) -> DataFrame:
    """What ``keep`` takes of every (anchors, block) cell: (anchor, vec_id, row, score)."""
    block = F.pmod(F.xxhash64("row", F.lit(3)), F.lit(blocks)).cast("int")
    chunk = F.pmod(F.xxhash64("row", F.lit(5)), F.lit(chunks)).cast("int")
    data = rows.toDF(*rows.columns).withColumn("block", block).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    asked = anchors.withColumn("chunk", chunk).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    cell = ("n", "block", "chunk")
    return asked.groupBy(*cell).cogroup(data.groupBy(*cell)).applyInArrow(
        _scored(keep), "anchor long, vec_id long, row long, score long"
    )


def _matrix(table: pa.Table) -> np.ndarray:
    flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(table.num_rows, len(flat) // max(1, table.num_rows))


def _scored(keep):
    schema = pa.schema([(c, pa.int64()) for c in ("anchor", "vec_id", "row", "score")])

    def work(asked: pa.Table, data: pa.Table) -> pa.Table:
        if not asked.num_rows or not data.num_rows:
            return schema.empty_table()
        # by id: a stable sort by score leaves ties in order of id
        data = data.take(np.lexsort((data.column("row").to_numpy(), data.column("vec_id").to_numpy())))
        ids, rows, labels = (data.column(c).to_numpy() for c in ("vec_id", "row", "label"))
        x, q = _matrix(data), _matrix(asked)
        largest = [float(np.abs(m).max(initial=0)) for m in (x, q)]
        if largest[0] * largest[1] * max(1, x.shape[1]) < 2.0**53:  # doubles are exact, and faster
            x, q = x.astype(np.float64), q.astype(np.float64)
        names, own, own_label = (asked.column(c).to_pylist() for c in ("row", "vec_id", "label"))
        windows, out, step = asked.column("scores").to_pylist(), [], max(1, STRIP_SCORES // len(ids))
        for a in range(0, len(q), step):
            for k, scores in enumerate((q[a : a + step] @ x.T).astype(np.int64), a):
                taken = keep(scores, (labels == own_label[k]), ids != own[k], windows[k])
                out.append((np.full(len(taken), names[k]), ids[taken], rows[taken], scores[taken]))
        return pa.table([np.concatenate(c) for c in zip(*out)], schema=schema)

    return work


def _first(scores: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """The k best of ``places``, which are in order of id; ties to the earlier place."""
    if len(places) > k:
        mine = scores[places]
        edge = np.partition(mine, len(mine) - k)[len(mine) - k]
        above, ties = places[mine > edge], places[mine == edge]
        places = np.concatenate([above, ties[: k - len(above)]])
    return places


def _own_label(k: int):
    return lambda scores, same, other, _: _first(scores, np.flatnonzero(same & other), k)


def _other_labels(k: int, low: int, high: int):
    def keep(scores: np.ndarray, same: np.ndarray, other: np.ndarray, windows: list[int]) -> np.ndarray:
        taken = [np.zeros(0, np.int64)]
        free = ~same & other
        for s in windows:
            # least and largest whole score inside the window
            a, b = -((-low * s) // 100), (high * s) // 100
            if a <= b:
                taken.append(_first(scores, np.flatnonzero(free & (scores >= a) & (scores <= b)), k))
        return np.unique(np.concatenate(taken))

    return keep


# Key: anchor id, anchor row, falling score, id; big-endian and shifted to unsigned, so that bytes sort like numbers.
_KEY = struct.Struct(">QQQQ")
_SHIFT = 1 << 63


def pack(anchor_id: int, row: int, score: int, vec_id: int) -> bytes:
    return _KEY.pack(anchor_id + _SHIFT, row + _SHIFT, _SHIFT - 1 - score, vec_id + _SHIFT)


def unpack(key: bytes) -> tuple[int, int, int, int]:
    anchor_id, row, falling, vec_id = _KEY.unpack(key)
    return anchor_id - _SHIFT, row - _SHIFT, _SHIFT - 1 - falling, vec_id - _SHIFT


def by_anchor(key: bytes) -> int:
    """Where a key goes: all of an anchor to one place, the same on every executor."""
    return zlib.crc32(key[:16])


def _sorted_windows(pairs: DataFrame, negatives: int, low: int, high: int) -> DataFrame:
    """The secondary sort and the iterator behind it."""
    spark = pairs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = pairs.select("anchor_id", "anchor", "score", "vec_id", "positive").rdd.map(
        lambda r: (pack(r[0], r[1], r[2], r[3]), r[4])
    )
    dealt = keyed.repartitionAndSortWithinPartitions(parts, by_anchor)
    return spark.createDataFrame(dealt.mapPartitions(lambda it: windows_of(it, negatives, low, high)), RESULT)


def windows_of(pairs: Iterator[tuple[bytes, bool]], negatives: int, low: int, high: int) -> Iterator[tuple]:
    """Negatives per positive from (key, is positive) in order of the key, one pass.

    A window is [positive's id, its score, negatives given out]. Equal scores of a
    positive and a negative fit in no window but that of score zero, where the
    negative may come first by its id; so negatives of score zero wait for the
    end of the anchor's zeros, as many as a window holds.
    """
    anchor, open_windows, zeros = None, [], []

    def given(vec_id: int, score: int) -> Iterator[tuple]:
        for w in open_windows:
            if w[2] < negatives and low * w[1] <= 100 * score <= high * w[1]:
                w[2] += 1
                yield anchor[0], w[0], w[2], vec_id, w[1], score

    for key, positive in pairs:
        anchor_id, row, score, vec_id = unpack(key)
        same = (anchor_id, row) == anchor
        if zeros and not (same and score == 0):
            for z in zeros:
                yield from given(z, 0)
            zeros = []
        if not same:
            anchor, open_windows = (anchor_id, row), []
        if positive:
            open_windows.append([vec_id, score, 0])
        elif score == 0:
            if len(zeros) < negatives:
                zeros.append(vec_id)
        else:
            # full windows, and those whose lower end lies above this score, take nothing any more
            open_windows = [w for w in open_windows if w[2] < negatives and low * w[1] <= 100 * score]
            yield from given(vec_id, score)
    for z in zeros:
        yield from given(z, 0)
