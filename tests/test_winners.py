"""Rows picked by their numbers: the right ones, and none is moved for it."""

import json

import pytest
from helpers import frame
from pyspark.sql import functions as F

from corpusloom.operators import winners
from corpusloom.plans import corpus_flow
from corpusloom.session import stage, work_dir
from corpusloom.sources import calls


@pytest.fixture
def no_broadcast_by_size(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def attempts(spark):
    """Three attempts a key; the numbers of a task's rows go beyond a bitmap."""
    rows = spark.range(0, 300_000, 1, 4)
    return rows.select((F.col("id") % 100_000).alias("k"), (F.col("id") * 7 % 11).alias("o"), F.concat(F.lit("t"), "id").alias("text"))


def best(rows):
    return {(r["k"], r["o"]) for r in rows.groupBy("k").agg(F.min("o").alias("o")).collect()}


@pytest.mark.parametrize("most", [winners.MOST_BITMAPS, 0])
def test_winners_by_bitmap_or_by_join(spark, monkeypatch, most):
    monkeypatch.setattr(winners, "MOST_BITMAPS", most)
    rows = attempts(spark)
    got = winners.winning_rows(rows, ["k"], F.col("o"), count="n").collect()
    assert len(got) == 100_000 and {r["n"] for r in got} == {3}
    assert {(r["k"], r["o"]) for r in got} == best(rows)


def test_no_text_is_shuffled_for_its_number(spark, no_broadcast_by_size):
    won = winners.winning_rows(attempts(spark), ["k"], F.col("o"))
    assert won.count() == 100_000
    plan = won._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_places_within_files(spark):
    path = work_dir(spark, "files")
    rows = stage(spark.range(0, 100_000, 1, 3).select("id", F.col("id").cast("string").alias("text")), path)
    placed = rows.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    got = winners.rows_at(placed, placed.where("id % 3 = 1 or id in (0, 99999)"), "row", "file")
    assert sorted(r["id"] for r in got.collect()) == sorted({*range(1, 100_000, 3), 0, 99_999})
    assert winners.rows_at(placed, placed.where("false"), "row", "file").count() == 0


@pytest.mark.parametrize("bits", [winners.SIEVE_BITS, 1])
def test_a_sieve_loses_no_row_and_moves_none(spark, no_broadcast_by_size, monkeypatch, bits):
    monkeypatch.setattr(winners, "SIEVE_BITS", bits)
    rows, wanted = attempts(spark), spark.range(0, 100_000, 10).select(F.col("id").alias("k"))
    left = winners.sifted(rows, wanted, "k")
    assert left.where("k % 10 = 0").count() == 30_000
    assert left.count() == 300_000 if bits == 1 else left.count() < 31_000
    assert "hashpartitioning" not in left._jdf.queryExecution().executedPlan().toString()


def test_hashes_that_meet_win_nothing(spark, monkeypatch):
    """A sieve that lets everything through: answers to calls that are closed or not planned are not taken."""
    monkeypatch.setattr(winners, "SIEVE_BITS", 1)
    long = "x" * 201
    schema = "call_id string, stage int, attempt int, raw string"
    answers = [(c, 0, a, json.dumps([{"instruction": f"{c}{a}", "output": long}])) for c in ("a", "b", "unplanned", None) for a in (1, 2)]
    answers[2] = ("b", 0, 1, "no")
    plan = frame(spark, "call_id string, ordinal int, filename string", ("a", 0, "f"), ("b", 1, "f"))
    done = corpus_flow.call_corpus(plan, frame(spark, schema, *answers), work_dir(spark, "calls"), corpus_flow.batch_family("m"))
    assert sorted((r["call_id"], r["instruction"]) for r in done.records.collect()) == [("a", "a1"), ("b", "b2")]


def test_stored_records_stay_where_they_are_read(spark, no_broadcast_by_size):
    """Buckets written by one task have files of one name in several folders."""
    path = work_dir(spark, "calls")
    rows = spark.range(4000).select(F.concat(F.lit("c"), F.col("id") % 2000).alias("call_id"), F.lit(1).alias("v")).coalesce(1)
    calls.overwrite_calls(rows, path, bucket_rows=500)
    calls.overwrite_calls(rows.where("substring(call_id, -1) = '7'").withColumn("v", F.lit(2)), path, bucket_rows=400)
    got = {(r["call_id"], r["v"]): r["count"] for r in calls.read_calls(spark, path).groupBy("call_id", "v").count().collect()}
    assert got == {(f"c{k}", 2 if k % 10 == 7 else 1): 2 for k in range(2000)}


def test_staged_tables_are_packed_tightly(spark):
    path = work_dir(spark, "staged")
    assert all(".zstd." in f for f in stage(spark.range(10), path).inputFiles())
