import json

import pandas as pd
import pytest
from helpers import frame
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import catalog, inference
from corpusloom.catalog.incremental import RECORDS, VERDICTS
from corpusloom.inference import infer, infer_packed, message_tokens, with_bins
from corpusloom.operators import judging
from corpusloom.operators import responses as R
from corpusloom.plans.calling import call_rounds
from corpusloom.session import work_dir
from corpusloom.sources import manifest
from corpusloom.streaming import incremental as I
from corpusloom.streaming import log as L

SF_DIR = "/root/testdata/sf0.001"
LONG = "x" * 201
RAW = "call_id string, raw string, attempt int"


def flat(log):
    return sorted((r["call_id"], r["pos"], r["instruction"]) for r in log.collect())


def answer(text):
    return json.dumps([{"instruction": text, "output": LONG}])


@pytest.fixture
def inbox(spark):
    path = work_dir(spark, "inbox")

    def deliver(*rows):
        frame(spark, RAW, *rows).coalesce(1).write.mode("append").json(path)

    return path, deliver


def both(text):
    return json.dumps([{"instruction": text, "output": LONG}, {"instruction": "x", "output": "short"}, {"instruction": text + "2", "output": LONG}])


def run(spark, path, log, checkpoint):
    arriving = spark.readStream.schema(RAW).json(path)
    I.run_generation(arriving, I.first_records, log, checkpoint, RECORDS, "call_id").awaitTermination()
    return L.read_log(spark, log, RECORDS)


def test_resume_reads_new_files_only(spark, inbox):
    path, deliver = inbox
    log, checkpoint = work_dir(spark, "log"), work_dir(spark, "checkpoint")
    deliver(("a", both("first"), 1), ("b", "broken", 1))
    assert flat(run(spark, path, log, checkpoint)) == [("a", 0, "first"), ("a", 2, "first2")]
    # a failed call is tried again, a finished one is not replaced
    deliver(("a", answer("second"), 2), ("b", answer("late"), 2))
    want = [("a", 0, "first"), ("a", 2, "first2"), ("b", 0, "late")]
    assert flat(run(spark, path, log, checkpoint)) == want
    assert flat(run(spark, path, log, checkpoint)) == want


def test_a_new_checkpoint_keeps_the_old_log(spark, inbox):
    path, deliver = inbox
    log = work_dir(spark, "log")
    deliver(("a", both("first"), 1), ("b", answer("b"), 1))
    first = flat(run(spark, path, log, work_dir(spark, "checkpoint")))
    deliver(("a", answer("again"), 1), ("c", answer("c"), 1))
    assert flat(run(spark, path, log, work_dir(spark, "checkpoint"))) == sorted([*first, ("c", 0, "c")])


def test_two_answers_in_one_batch(spark, inbox):
    path, deliver = inbox
    deliver(("a", answer("second"), 2), ("a", both("first"), 1), ("b", "broken", 1), ("b", answer("later"), 2))
    got = flat(run(spark, path, work_dir(spark, "log"), work_dir(spark, "checkpoint")))
    assert got == [("a", 0, "first"), ("a", 2, "first2"), ("b", 0, "later")]


def test_replayed_batch_changes_nothing(spark):
    log = work_dir(spark, "log")
    L.open_log(spark, log, RECORDS)
    rows = frame(spark, RECORDS, ("a", 0, "i", "", "o", "{}"), ("a", 1, "i", "", "o", "{}"), ("b", 0, "i", "", "o", "{}"))
    for run_id, batch_id in (("r", 0), ("r", 0), ("r", 1), ("s", 0), ("s", 0), ("r", 0)):
        L.append_batch(rows, batch_id, log, RECORDS, "call_id", run=run_id)
    got = L.read_log(spark, log, RECORDS).collect()
    assert sorted((r["call_id"], r["pos"], r["run_id"], r["batch_id"]) for r in got) == [("a", 0, "r", 0), ("a", 1, "r", 0), ("b", 0, "r", 0)]


def test_judge_errors_stay_open(spark):
    log = work_dir(spark, "verdicts")
    L.open_log(spark, log, VERDICTS)
    zero = {s: F.lit(0.0) for s in (*judging.SCORES, "avg_score")}
    failed = frame(spark, "content_key string", ("k",)).withColumns(zero | {"verdict": F.lit("reject"), "reason": F.lit("error")})
    L.append_batch(failed, 0, log, VERDICTS, "content_key", done=judging.resumable)
    good = failed.withColumn("avg_score", F.lit(4.0))
    for batch_id in (1, 2):
        L.append_batch(good, batch_id, log, VERDICTS, "content_key", done=judging.resumable)
    rows = I.settled_verdicts(L.read_log(spark, log, VERDICTS)).collect()
    assert [(r["content_key"], r["avg_score"]) for r in rows] == [("k", 4.0)]


def test_running_report_covers_all_batches(spark):
    source, out, checkpoint = (work_dir(spark, n) for n in ("judged", "report", "checkpoint"))
    schema = "category string, verdict string"

    def run():
        I.run_report(spark.readStream.schema(schema).json(source), out, checkpoint).awaitTermination()
        return {tuple(r) for r in manifest.read_published(spark, out).collect()}

    frame(spark, schema, ("a", "accept"), (None, "reject")).write.mode("append").json(source)
    assert run() == {("a", 1, 0, 100.0), ("unknown", 0, 1, 0.0)}
    frame(spark, schema, ("a", "reject")).write.mode("append").json(source)
    assert run() == {("a", 1, 1, 50.0), ("unknown", 0, 1, 0.0)}


@pytest.fixture
def tables_in_folders(spark):
    """The documents as a folder of several files, beside another table."""
    path = work_dir(spark, "tables")
    for name, parts in (("documents", 3), ("labels", 2)):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").repartition(parts).write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.mark.parametrize("name", ["i1_stream_parse", "i4_running"])
def test_streams_read_tables_of_many_files(spark, tables_in_folders, name):
    def rows(sf_dir):
        return sorted(map(tuple, catalog.QUERIES[name](spark, sf_dir).collect()))

    got = rows(tables_in_folders)
    assert got and got == rows(SF_DIR)


def test_rounds_ask_only_for_open_keys(spark):
    def model(prompts):
        return prompts.map(lambda p: None if p == "fail" else f"{p} x{len(prompts)}" if p != "late" else "short")

    plan = frame(spark, "k int, p string, q string", (1, "good", "again"), (2, "late", "second"), (3, "fail", "fail")).coalesce(1)
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("raw", T.StringType())])
    path = work_dir(spark, "rounds")
    log = call_rounds(plan, model, lambda a: a.where("raw like '% x%'"), path, schema, "k", ("p", "q", "q"), slices=1)
    # the second round asks for two keys, the third for one more and gets nothing
    assert sorted((r["k"], r["batch_id"], r["raw"][-2:]) for r in log.collect()) == [(1, 0, "x3"), (2, 1, "x2")]
    # a later run goes on where this one ended
    plan = plan.withColumn("q", F.lit("third"))
    log = call_rounds(plan, model, lambda a: a.where("raw like '% x%'"), path, schema, "k", ("q",), slices=1)
    assert sorted((r["k"], r["batch_id"], r["raw"]) for r in log.where("k = 3").collect()) == [(3, 3, "third x1")]


def test_a_stopped_round_asks_no_stored_key_again(spark):
    plan = spark.range(40).select(F.col("id").alias("k"), F.concat(F.lit("p"), "id").alias("p"))
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("raw", T.StringType())])
    path, asked = work_dir(spark, "rounds"), work_dir(spark, "asked")

    def model(name, stop=None):
        def call(prompts):
            if stop and stop in set(prompts):
                raise RuntimeError("stopped")
            return prompts.map(lambda p: f"{name} {p}")

        return call

    with pytest.raises(Exception, match="stopped"):
        call_rounds(plan, model("one", "p7"), lambda a: a, path, schema, "k", ("p",), slices=8)
    log = call_rounds(plan, model("two"), lambda a: a, path, schema, "k", ("p",), slices=8).collect()
    by = {r["k"]: r["raw"].split()[0] for r in log}
    assert len(log) == 40 and by[7] == "two"
    where = {r["k"]: r["s"] for r in plan.select("k", F.pmod(F.xxhash64("k"), F.lit(8)).alias("s")).collect()}
    assert all((by[k] == "one") == (where[k] < where[7]) for k in by)


def test_a_broken_slice_is_asked_again(spark):
    """A slice without the mark of its end, and with one of its keys in it, is no answer."""
    plan = spark.range(40).select(F.col("id").alias("k"), F.concat(F.lit("p"), "id").alias("p"))
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("raw", T.StringType())])
    path = work_dir(spark, "rounds")
    broken = plan.where(F.pmod(F.xxhash64("k"), F.lit(8)) == 3).limit(1).select("k", F.lit("broken").alias("raw"))
    broken.write.parquet(f"{path}/answers/round=0/slice=3/whole")
    manifest.remove(spark, f"{path}/answers/round=0/slice=3/whole/_SUCCESS")
    log = call_rounds(plan, lambda prompts: prompts + "!", lambda a: a, path, schema, "k", ("p",), slices=8).collect()
    assert {r["k"]: r["raw"] for r in log} == {k: f"p{k}!" for k in range(40)}


def test_infer(spark):
    def model(prompts: pd.Series) -> pd.Series:
        return prompts.map(lambda p: None if p == "fail" else p + "!")

    df = frame(spark, "id int, prompt string", (1, "a"), (2, "fail"))
    assert {r["id"]: r["raw"] for r in infer(df, model, "id", tasks=2).collect()} == {1: "a!", 2: None}


def test_long_prompts_come_in_small_batches(spark):
    """By their bytes, not by their number; the last one of a batch may go beyond the bound."""
    def model(prompts):
        chars = prompts.str.len()
        assert chars.iloc[:-1].sum() <= 6 << 20
        return chars.astype(str)

    size = F.when(F.col("id") == 100, 9_000_000).otherwise(100_000).cast("int")
    plan = spark.range(0, 200, 1, 1).select("id", F.repeat(F.lit("x"), size).alias("prompt"))
    got = {r["id"]: r["raw"] for r in infer(plan, model, "id").collect()}
    assert got == {k: "9000000" if k == 100 else "100000" for k in range(200)}


def test_calls_are_packed_by_tokens(spark):
    """Every task has about the budget's tokens, whichever keys are dear; a call over the budget stands alone."""
    rows = spark.range(400).select(
        F.col("id").alias("k"), F.array(F.struct(F.lit("user").alias("role"), F.repeat(F.lit("x"), (F.when(F.col("id") < 40, 400).otherwise(8)).cast("int")).alias("content"))).alias("messages"),
        F.when(F.col("id") == 200, 5000).when(F.col("id") % 7 == 0, None).otherwise(10).alias("max_tokens"),
    )
    cost = message_tokens("messages", "max_tokens")
    binned, n = with_bins(rows, "k", cost, 1000)
    sums = {r["_bin"]: (r["t"], r["n"], r["most"]) for r in binned.groupBy("_bin").agg(F.sum(cost).alias("t"), F.count(F.lit(1)).alias("n"), F.max(cost).alias("most")).collect()}
    assert sum(x[1] for x in sums.values()) == 400 and all(t < 1000 + most for t, _, most in sums.values())
    assert n == max(sums) + 1

    def model(calls):
        assert len(calls) <= 16
        part = TaskContext.get().partitionId()
        return calls["max_tokens"].map(lambda t: f"{part} {t}")

    got = infer_packed(rows, model, "k", ("messages", "max_tokens"), cost, 1000, in_flight=16).collect()
    where = {r["k"]: r["raw"].split()[0] for r in got}
    assert len(got) == 400 and len(set(where.values())) >= len(sums)
    # no task has the calls of two bins
    bins = {r["k"]: r["_bin"] for r in binned.select("k", "_bin").collect()}
    assert len({(where[k], bins[k]) for k in where}) == len(set(where.values()))


def test_packed_tasks_are_bounded(spark, monkeypatch):
    """Far more budgets than tasks: every task has as many of them, one in a row behind the other."""
    monkeypatch.setattr(inference, "MOST_TASKS", 4)
    monkeypatch.setattr(inference, "TASKS_PER_CORE", 0)
    message = F.array(F.struct(F.lit("user").alias("role"), F.repeat(F.lit("x"), 40).alias("content")))
    calls = spark.range(1000).select(F.col("id").alias("k"), message.alias("messages"), F.lit(10).alias("max_tokens"))

    def model(part):
        return part["max_tokens"].map(lambda _: str(TaskContext.get().partitionId()))

    got = infer_packed(calls, model, "k", ("messages", "max_tokens"), message_tokens("messages", "max_tokens"), 100, in_flight=16).collect()
    where = [r["raw"] for r in sorted(got, key=lambda r: r["k"])]
    assert len(where) == 1000 and sorted(where.count(t) for t in set(where)) == [250] * 4
    assert sum(a != b for a, b in zip(where, where[1:])) == 3


def test_packing_nothing(spark):
    none = spark.createDataFrame([], "k long, messages array<struct<role:string,content:string>>, max_tokens int")
    assert infer_packed(none, lambda c: c["max_tokens"].astype(str), "k", ("messages", "max_tokens"), message_tokens("messages", "max_tokens"), 10).count() == 0
