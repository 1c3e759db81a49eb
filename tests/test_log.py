"""Logs of finished keys: what a batch reads, merges, readers, replays."""

import os
import threading

import pytest
from helpers import frame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.session import work_dir
from corpusloom.sources import manifest
from corpusloom.streaming import incremental as I
from corpusloom.streaming import log as L

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


def rows(spark, keys, v="x"):
    return spark.createDataFrame([(k, v) for k in keys], SCHEMA).coalesce(1)


def append(df, n, path, **more):
    L.append_batch(df, n, path, SCHEMA, "k", **{"fanout": 3, "bucket_rows": 8, **more})


def held(spark, path):
    return sorted((r["k"], r["v"], r["batch_id"]) for r in L.read_log(spark, path, SCHEMA).collect())


def test_a_batch_reads_no_more_as_the_log_grows(spark):
    path, read = work_dir(spark, "log"), []
    L.open_log(spark, path, SCHEMA)
    for n in range(24):
        keys = rows(spark, [n * 4 + i for i in range(4)])
        files = L.finished_rows(keys, path, manifest.latest(spark, path)[1]["parts"], SCHEMA, "k").inputFiles()
        read.append(sum(os.path.getsize(f.removeprefix("file:").replace("//", "/")) for f in files))
        append(keys, n, path)
    assert held(spark, path) == sorted((k, "x", k // 4) for k in range(96))
    parts = manifest.latest(spark, path)[1]["parts"]
    # few folders, the merged ones in buckets of bounded size
    assert len(parts) <= 3 * 3 and max(p["buckets"] for p in parts) >= 8
    assert max(read[16:]) <= 1.5 * max(read[6:12])
    assert max(read[16:]) < sum(sum(os.path.getsize(os.path.join(d, f)) for f in fs if f.endswith(".parquet")) for d, _, fs in os.walk(path)) / 3


def test_readers_keep_their_version_while_folders_are_merged(spark):
    path = work_dir(spark, "log")
    L.open_log(spark, path, SCHEMA)
    for n in range(3):
        append(rows(spark, [n]), n, path)
    before = L.read_log(spark, path, SCHEMA)  # the folders of this version, read later
    for n in range(3, 9):
        append(rows(spark, [n]), n, path)
    assert sorted(r["k"] for r in before.collect()) == [0, 1, 2]
    assert [r[0] for r in held(spark, path)] == list(range(9))
    # folders that no recent version needs are gone
    manifest.clean_up(spark, path, keep=1)
    assert len(manifest.names_in(spark, f"{path}/data")) == len(manifest.latest(spark, path)[1]["parts"]) < 6
    assert [r[0] for r in held(spark, path)] == list(range(9))


def test_finished_keys_are_left_out_wherever_they_are(spark):
    path = work_dir(spark, "log")
    L.open_log(spark, path, SCHEMA)
    for n in range(10):
        append(rows(spark, [n, n, n + 1, 100], f"v{n}"), n, path)  # n was finished as n + 1 of the batch before
    want = [(0, "v0", 0), (0, "v0", 0), (1, "v0", 0), (100, "v0", 0)] + [(n + 1, f"v{n}", n) for n in range(1, 10)]
    assert held(spark, path) == sorted(want)


def test_a_folder_has_no_more_buckets_than_it_may(spark, monkeypatch):
    """And a batch that falls into all of them reads the folder as one."""
    monkeypatch.setattr(L, "MOST_BUCKETS", 4)
    path = work_dir(spark, "log")
    L.open_log(spark, path, SCHEMA)
    for n in range(7):
        append(rows(spark, [n * 40 + i for i in range(40)]), n, path)
    parts = manifest.latest(spark, path)[1]["parts"]
    assert max(p["buckets"] for p in parts) == 4
    append(rows(spark, range(300)), 7, path)
    assert held(spark, path) == sorted((k, "x", min(k // 40, 7)) for k in range(300))
    merged = next(p for p in parts if p["buckets"] == 4)
    paths = []
    monkeypatch.setattr(manifest, "read_folders", lambda spark, path, folders, schema: paths.extend(folders))
    L.finished_rows(rows(spark, range(300)), path, [merged], SCHEMA, "k")
    assert paths == [merged["folder"]]


def test_merged_batches_are_not_replaced(spark):
    path = work_dir(spark, "log")
    L.open_log(spark, path, SCHEMA)
    for n in range(6):
        append(rows(spark, [n]), n, path)
    once = held(spark, path)
    append(rows(spark, [0], "again"), 0, path)
    assert held(spark, path) == once
    # the newest batch comes again and replaces itself; another run is no repetition
    append(rows(spark, [5, 50], "again"), 5, path)
    append(rows(spark, [5, 51], "other"), 5, path, run="other")
    assert held(spark, path) == sorted([r for r in once if r[0] != 5] + [(5, "again", 5), (50, "again", 5), (51, "other", 5)])


def test_null_keys_and_empty_batches(spark):
    path = work_dir(spark, "log")
    assert L.open_log(spark, path, SCHEMA).count() == 0
    append(rows(spark, []), 0, path)
    for n in range(1, 6):
        append(rows(spark, [None, n]), n, path)
    got = L.read_log(spark, path, SCHEMA)
    assert got.where("k is not null").count() == 5 and got.where("k is null").count() == 5  # a null key is never finished


def test_two_jobs_on_one_log(spark):
    path = work_dir(spark, "log")
    L.open_log(spark, path, SCHEMA)
    manifest.commit(spark, path, 1, {"folders": [], "parts": [], "merged": {}})
    with pytest.raises(RuntimeError, match="two jobs"):
        manifest.commit(spark, path, 1, {"folders": [], "parts": [], "merged": {}})


def test_the_verdict_committed_last_is_settled(spark):
    path = work_dir(spark, "verdicts")
    schema = "content_key string, avg_score double"
    df = frame(spark, schema, ("a", 2.0))
    L.open_log(spark, path, df.schema)
    for run, n, score in (("z", 7, 2.0), ("b", 0, 3.0), ("a", 1, 4.0)):
        batch = df.withColumn("avg_score", F.lit(score))
        L.append_batch(batch, n, path, df.schema, "content_key", done=lambda rows: rows.where("false"), run=run)
    assert [tuple(r) for r in I.settled_verdicts(L.read_log(spark, path, df.schema)).collect()] == [("a", 4.0)]


def test_a_run_keeps_its_name(spark):
    place = work_dir(spark, "checkpoint")
    name = I.run_of(spark, place)
    assert name and I.run_of(spark, place) == name
    assert manifest.get_text(spark, place + "-nothing") is None


def test_a_report_is_never_missing(spark):
    path, stop, seen = work_dir(spark, "report"), threading.Event(), []
    manifest.publish(frame(spark, "n int", (0,)), path)

    def look():
        while not stop.is_set():
            seen.append([r["n"] for r in manifest.read_published(spark, path).collect()])

    reader = threading.Thread(target=look)
    reader.start()
    for n in range(1, 8):
        manifest.publish(frame(spark, "n int", (n,)), path)
    stop.set()
    reader.join()
    assert len(seen) > 3 and all(len(s) == 1 for s in seen) and seen == sorted(seen)
    assert [r["n"] for r in manifest.read_published(spark, path).collect()] == [7]
