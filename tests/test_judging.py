import json

import pytest
from helpers import frame
from pyspark.sql import functions as F

from corpusloom.operators import judging as G
from corpusloom.operators import reports as R
from corpusloom.plans import judging_flow
from corpusloom.session import work_dir


def enforce(spark, *scores):
    row = G.enforce(frame(spark, ", ".join(f"{s} double" for s in G.SCORES), tuple(float(s) for s in scores))).first()
    return row["avg_score"], row["verdict"]


@pytest.mark.parametrize("scores, want", [
    ((3, 3, 4, 4), (3.5, "accept")), ((3, 3, 3, 4), (3.25, "reject")), ((5, 5, 5, 2), (4.25, "reject")),
    ((7, 7, 7, 3.5), (6.12, "accept")), ((3.496, 3.496, 3.496, 3.496), (3.5, "accept")), ((5, 5, 5, 5), (5.0, "accept")),
])
def test_enforced_verdict(spark, scores, want):
    assert enforce(spark, *scores) == want
    avg = round(sum(scores) / 4, 2)
    assert want == (avg, "accept" if min(scores) >= 3 and avg >= 3.5 else "reject")


def raw(*scores, verdict="accept", reason="r"):
    return json.dumps(dict(zip(G.SCORES, scores)) | {"verdict": verdict, "reason": reason})


@pytest.fixture
def examples(spark):
    rows = [("i1", "o1", "A"), ("i1", "o1", "B"), ("i2", "o2", "A"), ("i3", "o3", None), ("i4", None, "B")]
    return frame(spark, "instruction string, output string, category string", *rows).withColumn(
        "input", F.lit("")).withColumn("_source_file", F.concat(F.coalesce("category", F.lit("n")), F.lit(".jsonl")))


@pytest.fixture
def responses(spark):
    rows = [("i1", "o1", 1, "bad"), ("i1", "o1", 2, raw(4, 4, 4, 4)), ("i1", "o1", 3, raw(1, 1, 1, 1)),
            ("i2", "o2", 1, raw(5, 5, 5, 1)), ("i3", "o3", 5, raw(5, 5, 5, 5)), ("i4", None, 4, raw(5, 5, 5, 5, verdict="reject"))]
    df = frame(spark, "instruction string, output string, attempt int, raw string", *rows)
    return G.with_content_key(df).select("content_key", "attempt", "raw")


def test_flow(spark, examples, responses):
    out = work_dir(spark, "flow")
    done = judging_flow.judge_corpus(examples, responses, out, "someone", max_attempts=4)
    got = sorted((r["instruction"], r["category"] or "", r["avg_score"], r["verdict"], r["reason"]) for r in done.judged.collect())
    assert got == [
        ("i1", "A", 4.0, "accept", "r"), ("i1", "B", 4.0, "accept", "r"), ("i2", "A", 4.0, "reject", "r"),
        ("i3", "", 0.0, "reject", "Judge error after 4 attempts"), ("i4", "B", 5.0, "accept", "r"),
    ]
    assert done.summary.first().asDict() == {"total": 5, "accepted": 3, "rejected": 2, "acceptance_rate": 60.0,
                                             "avg_score_accepted": 4.33, "avg_score_rejected": 2.0}
    assert {tuple(r) for r in done.by_category.collect()} == {("A", 1, 1, 50.0), ("B", 2, 0, 100.0), ("unknown", 0, 1, 0.0)}
    assert [r["category"] for r in done.worst.collect()] == ["unknown", "A", "B"]
    clean = spark.read.json(f"{out}/clean")
    assert set(clean.columns) == {"instruction", "input", "output", "category", "_source_file"} and clean.count() == 3
    assert spark.read.json(f"{out}/final").count() == 3
    rejected = spark.read.json(f"{out}/rejected")
    assert {r["_qc"]["verdict"] for r in rejected.collect()} == {"reject"} and rejected.count() == 2
    report = [json.loads(r["value"]) for r in spark.read.text(f"{out}/report").collect()]
    assert any(r.get("judge") == "someone" and r["total"] == 5 for r in report)


def test_earlier_verdicts_win_and_errors_are_judged_again(spark, examples, responses):
    first = judging_flow.judged_examples(examples, responses, max_attempts=4)
    earlier = first.select("content_key", *G.VERDICT_COLUMNS).distinct()
    left = G.judge_work(G.with_content_key(examples), earlier)
    assert [(r["instruction"], r["copies"]) for r in left.collect()] == [("i3", 1)]
    better = responses.withColumn("raw", F.lit(raw(3, 3, 4, 4))).withColumn("attempt", F.lit(1))
    again = {r["instruction"]: r["avg_score"] for r in judging_flow.judged_examples(examples, better, earlier, 4).collect()}
    assert again == {"i1": 4.0, "i2": 4.0, "i3": 3.5, "i4": 5.0}


def test_requests(spark, examples):
    rows = judging_flow.judge_requests(examples, "sys", "{instruction}/{output}").collect()
    assert sorted(r["messages"][1]["content"] for r in rows) == ["i1/o1", "i2/o2", "i3/o3", "i4/"]


def test_split_is_a_partition(spark, examples, responses):
    judged = judging_flow.judged_examples(examples, responses, max_attempts=4)
    assert G.accepted(judged).count() + G.rejected(judged).count() == judged.count() == 5


def test_summary_of_nothing(spark):
    empty = frame(spark, "verdict string, avg_score double")
    assert R.qc_summary(empty).first().asDict() == {"total": 0, "accepted": 0, "rejected": 0, "acceptance_rate": 0.0,
                                                   "avg_score_accepted": 0.0, "avg_score_rejected": 0.0}


def test_worst_ties_by_name(spark):
    df = frame(spark, "category string, pass_rate double", *[(c, 50.0) for c in "gfedcba"], ("z", 10.0))
    assert [r["category"] for r in R.worst_categories(df).collect()] == ["z", "a", "b", "c", "d"]


def test_file_counts_in_plan_order(spark):
    plan = frame(spark, "ordinal int, filename string", (2, "a"), (1, "b"), (3, "none"), (4, "a"))
    rows = frame(spark, "filename string", ("a",), ("a",), ("b",), ("other",))
    got = R.planned_file_counts(plan, rows).orderBy("is_total", "ordinal").collect()
    assert [tuple(r) for r in got] == [(1, "b", 1, 0), (2, "a", 2, 0), (4, "a", 2, 0), (None, None, 5, 1)]
    total = R.file_counts(rows).where("is_total = 1").first()
    assert total["n"] == 4


def test_shortfall(spark):
    got = {tuple(r) for r in R.shortfall(frame(spark, "category string", ("a",), ("a",), ("b",)), target=2).collect()}
    assert got == {("a", 2, 0), ("b", 1, 1)}
