"""Records replaced call by call."""

import os

from helpers import frame
from pyspark.sql import functions as F

from corpusloom import session
from corpusloom.sources import calls, manifest


def held(spark, path):
    return sorted(((r["call_id"], r["v"]) for r in calls.read_calls(spark, path).collect()), key=str)


def many(spark, a, b, v):
    return spark.range(a, b).select(F.concat(F.lit("c"), "id").alias("call_id"), F.lit(v).alias("v"))


def test_overwrite_replaces_only_its_calls(spark):
    path = session.work_dir(spark, "calls")
    calls.overwrite_calls(frame(spark, "v int, call_id string", (1, "a"), (1, "a"), (1, "b"), (1, None)), path)
    for _ in range(2):
        calls.overwrite_calls(frame(spark, "v int, call_id string", (2, "a"), (2, None)), path)
    assert held(spark, path) == [("a", 2), ("b", 1), (None, 2)]


def test_another_bucket_size_leaves_one_copy(spark):
    path = session.work_dir(spark, "calls")
    for v, rows in enumerate((64, 48, 1000, 7)):
        calls.overwrite_calls(many(spark, 0, 100, v), path, bucket_rows=rows)
        assert held(spark, path) == sorted((f"c{i}", v) for i in range(100))


def test_buckets_grow_and_a_write_touches_few(spark):
    path, size = session.work_dir(spark, "calls"), 20
    for n in range(8):
        before = manifest.latest(spark, path)[1].get("buckets", {})
        calls.overwrite_calls(many(spark, n * 50, n * 50 + 50, n), path, bucket_rows=size)
        after = manifest.latest(spark, path)[1]
    assert held(spark, path) == sorted((f"c{i}", i // 50) for i in range(400))
    assert after["count"] == 20 and max(b["rows"] for b in after["buckets"].values()) < 4 * size
    # one call: its bucket alone is written anew, and none is split
    calls.overwrite_calls(many(spark, 7, 8, 99), path, bucket_rows=30)
    last = manifest.latest(spark, path)[1]["buckets"]
    assert sum(last[b] != after["buckets"].get(b) for b in last) == 1 and len(before) < len(last)
    assert held(spark, path) == sorted((f"c{i}", 99 if i == 7 else i // 50) for i in range(400))


def test_a_bucket_comes_from_where_its_calls_were(spark):
    ids = [f"c{i}" for i in range(300)]
    df = spark.createDataFrame([(i,) for i in ids], "call_id string")
    for small, large in ((1, 2), (3, 4), (5, 8), (6, 13), (8, 40), (1, 7)):
        rows = df.select(calls.bucket_of("call_id", small).alias("a"), calls.bucket_of("call_id", large).alias("b")).collect()
        assert all(calls.origin_of(r["b"], small) == r["a"] < small and r["b"] < large for r in rows)


def test_columns_that_come_later(spark):
    path = session.work_dir(spark, "calls")
    calls.overwrite_calls(frame(spark, "v int, call_id string", (1, "a"), (1, "b")), path)
    calls.overwrite_calls(frame(spark, "w string, v int, call_id string", ("new", 2, "b")), path)
    got = {r["call_id"]: (r["v"], r["w"]) for r in calls.read_calls(spark, path).collect()}
    assert got == {"a": (1, None), "b": (2, "new")}


def test_a_stopped_write_changes_nothing(spark, monkeypatch):
    path = session.work_dir(spark, "calls")
    calls.overwrite_calls(many(spark, 0, 30, 1), path, bucket_rows=10)

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(calls.manifest, "commit", stop)
        try:
            calls.overwrite_calls(many(spark, 0, 30, 2), path, bucket_rows=10)
        except RuntimeError:
            pass
    assert held(spark, path) == sorted((f"c{i}", 1) for i in range(30))
    calls.overwrite_calls(many(spark, 0, 30, 3), path, bucket_rows=10)
    assert held(spark, path) == sorted((f"c{i}", 3) for i in range(30))
    manifest.clean_up(spark, path, keep=1)
    files = [f for d, _, fs in os.walk(f"{path}/data") for f in fs if f.endswith(".parquet")]
    assert held(spark, path) == sorted((f"c{i}", 3) for i in range(30)) and len(files) < 12
