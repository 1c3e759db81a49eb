"""A log of finished keys that grows by batches and costs a batch no more as it grows.

The log is a set of written-once folders, named by a version (sources.manifest).
A batch is a folder of its own. FANOUT folders of a level are merged into one of
the next level, in buckets by a hash of the key, of about BUCKET_ROWS rows each,
however large the folder is, up to MOST_BUCKETS of them. To find out which of its keys are finished, a batch
reads the key column of the few folders not merged yet and, of each merged one,
of the buckets its own keys fall into. So it reads at most as many buckets as it
has keys from each of a number of folders that grows with the logarithm of the log, and every row is
rewritten once a level.

A merge is one commit: who reads the version before goes on with the folders
before. Folders that no recent version names are deleted by ``manifest.clean_up``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators.planning import remaining_work
from corpusloom.operators.winners import rows_at
from corpusloom.sources import manifest

# Columns of a log besides its own: who wrote a row, and the number of the commit, which orders all batches of all runs.
RUN, BATCH, COMMIT = "run_id", "batch_id", "commit_number"
BUCKET = "bucket"
FANOUT = 8
# Rows of a bucket when its folder is written.
BUCKET_ROWS = 1 << 18
# Buckets of a folder: each is a folder with a file to write, list and open. A larger one has larger buckets.
MOST_BUCKETS = 1 << 10


def open_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The log at ``path``, created empty when it is new."""
    if manifest.latest(spark, path)[0] < 0:
        manifest.commit(spark, path, 0, {"folders": [], "parts": [], "merged": {}})
    return read_log(spark, path, schema)


def with_own(schema: T.StructType) -> T.StructType:
    own = [T.StructField(RUN, T.StringType()), T.StructField(BATCH, T.LongType()), T.StructField(COMMIT, T.LongType())]
    return T.StructType([*schema.fields, *own])


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of the live version."""
    return manifest.read_folders(spark, path, manifest.latest(spark, path)[1]["folders"], with_own(schema))


def append_batch(
    new: DataFrame, batch_id: int, path: str, schema: T.StructType, key: str, done: Callable | None = None, run: str = "main",
    fanout: int | None = None, bucket_rows: int | None = None,
) -> None:
    """Write one batch of a log, leaving out keys that other batches finished.

    A batch is known by its run and number: run again it replaces itself, and no
    run writes over the batches of another. All rows of a key go together. The
    rows are written as they come; only where some of their keys prove finished
    are they written again without those, picked by their place in the files. A batch that was merged is not replaced
    any more: its run has gone on behind it.
    """
    spark = new.sparkSession
    fanout, bucket_rows = fanout or FANOUT, bucket_rows or BUCKET_ROWS
    number, content = manifest.latest(spark, path)
    if batch_id <= content["merged"].get(run, -1):
        return
    others = [p for p in content["parts"] if p["own"] != [run, batch_id]]
    own = {RUN: F.lit(run), BATCH: F.lit(batch_id).cast("long"), COMMIT: F.lit(number + 1).cast("long")}
    folder = manifest.new_folder(f"{run}-{batch_id}")
    new.select(*schema.names).withColumns(own).write.parquet(f"{path}/{folder}")
    written = manifest.read_folders(spark, path, [folder], with_own(schema))

    known = finished_rows(written.select(key), path, others, schema, key)
    finished = done(known) if done else known
    again = written.select(key).distinct().join(finished.select(key).distinct(), key, "left_semi")
    if not again.isEmpty():
        kept = manifest.new_folder(f"{run}-{batch_id}")
        placed = written.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
        open_rows = remaining_work(placed.select(key, "_file", "_row"), finished, key, unique=True)
        rows_at(placed, open_rows, "_row", "_file").select(*with_own(schema).names).write.parquet(f"{path}/{kept}")
        folder, written = kept, manifest.read_folders(spark, path, [kept], with_own(schema))
    rows = written.count()  # from the footers
    if rows:
        others = [*others, {"folder": folder, "rows": rows, "buckets": 1, "filled": [0], "level": 0, "own": [run, batch_id]}]
    _commit(spark, path, number + 1, others, content["merged"])
    merge(spark, path, schema, key, fanout, bucket_rows)


def _commit(spark: SparkSession, path: str, number: int, parts: list[dict], merged: dict[str, int]) -> None:
    manifest.commit(spark, path, number, {"folders": [p["folder"] for p in parts], "parts": parts, "merged": merged})


def finished_rows(keys: DataFrame, path: str, parts: list[dict], schema: T.StructType, key: str) -> DataFrame:
    """The rows of the log that may share a key with ``keys``; of merged folders the buckets these fall into."""
    spark = keys.sparkSession
    most = max((p["buckets"] for p in parts), default=1)
    touched = None
    if most > 1:  # numbers of buckets are powers of two: a smaller one follows from the largest
        touched = [r[0] for r in keys.select(bucket_of(key, most)).distinct().collect()]
    folders = []
    for p in parts:
        if p["buckets"] == 1:
            folders.append(p["folder"])
        else:
            filled = set(p["filled"])
            hit = sorted({t % p["buckets"] for t in touched} & filled)
            # all of them are one folder to list
            folders += [p["folder"]] if len(hit) == len(filled) else [f"{p['folder']}/{BUCKET}={b}" for b in hit]
    return manifest.read_folders(spark, path, folders, with_own(schema))


def bucket_of(key: str, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias(BUCKET)


def merge(spark: SparkSession, path: str, schema: T.StructType, key: str, fanout: int = FANOUT, bucket_rows: int = BUCKET_ROWS) -> None:
    """Merge the folders of every level that has ``fanout`` of them, the newest batch of each run aside.

    That batch may come again: it stays a folder of its own until its run has gone on.
    """
    while True:
        number, content = manifest.latest(spark, path)
        newest: dict[str, int] = {}
        for p in content["parts"]:
            if p["own"]:
                newest[p["own"][0]] = max(p["own"][1], newest.get(p["own"][0], -1))
        levels: dict[int, list[dict]] = {}
        for p in content["parts"]:
            if not p["own"] or p["own"][1] < newest[p["own"][0]]:
                levels.setdefault(p["level"], []).append(p)
        full = [level for level, parts in sorted(levels.items()) if len(parts) >= fanout]
        if not full:
            manifest.clean_up(spark, path)
            return
        parts = levels[full[0]]
        rows = sum(p["rows"] for p in parts)
        buckets = 1
        while buckets * bucket_rows < rows and buckets < MOST_BUCKETS:
            buckets *= 2
        folder = manifest.new_folder(f"level-{full[0] + 1}")
        table = manifest.read_folders(spark, path, [p["folder"] for p in parts], with_own(schema))
        table.withColumn(BUCKET, bucket_of(key, buckets)).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/{folder}")
        filled = [int(n.split("=")[1]) for n in manifest.names_in(spark, f"{path}/{folder}") if n.startswith(f"{BUCKET}=")]
        merged = dict(content["merged"])
        for p in parts:
            if p["own"]:
                merged[p["own"][0]] = max(p["own"][1], merged.get(p["own"][0], -1))
        one = {"folder": folder, "rows": rows, "buckets": buckets, "filled": filled, "level": full[0] + 1, "own": None}
        gone = {p["folder"] for p in parts}
        _commit(spark, path, number + 1, [one, *[p for p in content["parts"] if p["folder"] not in gone]], merged)
