"""One key holds a third of all rows: results stay whole and no task gets them all."""

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import judging, skew
from corpusloom.operators.formats import assemble_chat, check_chat
from corpusloom.operators.planning import remaining_work


FIXED = {
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    # small enough for these tables
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
}


@pytest.fixture
def fixed_partitions(spark):
    old = {k: spark.conf.get(k, None) for k in FIXED}
    for k, v in FIXED.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def rows(spark):
    return spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 1500)).alias("key"))


def biggest_task(df):
    """Rows of the fullest task; looking at every column keeps the join in the plan."""
    placed = df.select(F.spark_partition_id().alias("p"), F.hash(*df.columns).alias("h"))
    return placed.groupBy("p").agg(F.count("h").alias("n"), F.max("h").alias("h")).agg(F.max("n"), F.max("h")).first()[0]


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_same_as_a_plain_join(spark, rows, how):
    lookup = spark.range(0, 1400, 2).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("v"))
    lookup = lookup.unionByName(spark.createDataFrame([("hot", -1)], "key string, v long"))
    joined, plain = skew.lookup_join(rows, lookup, "key", how), rows.join(lookup, "key", how)
    assert sorted(map(tuple, joined.select(*plain.columns).collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_hot_key_is_spread(spark, rows, fixed_partitions):
    rows = rows.repartition(12)
    lookup = rows.groupBy("key").agg(F.max("id").alias("v"))
    joined = skew.lookup_join(rows, lookup, "key", "left")
    assert biggest_task(joined) < 1500
    assert joined.count() == 9000


def test_rows_without_a_key_are_spread(spark, rows, fixed_partitions):
    some = rows.withColumn("key", F.when(F.col("key") != "hot", F.col("key"))).repartition(12)
    lookup = some.where("key is not null").groupBy("key").agg(F.max("id").alias("v"))
    joined = skew.lookup_join(some, lookup, "key", "left")
    assert joined.where("v is null").count() == 3000
    assert biggest_task(joined) < 1500


def test_verdicts_of_a_text_copied_very_often(spark, fixed_partitions):
    ex = judging.with_content_key(spark.range(9000).select(
        "id", F.lit("i").alias("instruction"),
        F.when(F.col("id") % 3 == 0, "copy").otherwise(F.col("id").cast("string")).alias("output"))).repartition(12)
    work = judging.judge_work(ex)
    scores = {s: F.lit(4.0) for s in judging.SCORES}
    verdicts = judging.enforce(work.select("content_key").withColumns(scores)).withColumn("reason", F.lit("r"))
    judged = judging.attach(ex, verdicts)
    assert judged.where("verdict = 'accept'").count() == 9000
    assert biggest_task(judged) < 2500


def test_plan_with_one_prompt_repeated(spark, rows, fixed_partitions):
    left = remaining_work(rows.repartition(12), spark.createDataFrame([("k1",)], "key string"), "key")
    assert left.count() == 9000 - rows.where("key = 'k1'").count()
    assert biggest_task(left) < 1500


@pytest.fixture
def long_conversation(spark):
    turn = F.col("id").alias("turn")
    role = F.when(F.col("id") % 2 == 0, "user").otherwise("assistant")
    # equal neighbours inside a part, at the end of a part, and a late system turn
    role = F.when(F.col("id").isin(11, 1024), "user").when(F.col("id") == 2048, "system").otherwise(role)
    return spark.range(5000).select(F.lit(1).cast("long").alias("conv_id"), turn, role.alias("role"), F.concat(F.lit("t"), "id").alias("text"))


def test_long_conversation_is_checked_in_parts(long_conversation):
    got = check_chat(long_conversation).first().asDict()
    roles = [r["role"] for r in long_conversation.orderBy("turn").collect()]
    repeats = sum(a == b for a, b in zip(roles, roles[1:]))
    assert got == {"conv_id": 1, "turns": 5000, "bad_roles": 0, "blank_turns": 0, "late_systems": 1, "repeats": repeats, "ok": False}


def test_long_conversation_is_kept_whole(long_conversation):
    rows = assemble_chat(long_conversation).collect()
    assert len(rows) == 1 and [m["content"] for m in rows[0]["messages"]] == [f"t{i}" for i in range(5000)]


def test_turns_without_a_role(spark):
    roles = ["user", None, "system", "assistant"]
    turns = spark.createDataFrame([(1, k, r, "t") for k, r in enumerate(roles)] + [(2, 1023, None, "t"), (2, 1024, "system", "t")],
                                  "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: (r["bad_roles"], r["late_systems"], r["repeats"]) for r in check_chat(turns).collect()}
    assert got == {1: (1, 1, 0), 2: (1, 1, 0)}
