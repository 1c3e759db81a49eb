"""What the physical plans must look like to hold at scale."""

import re

import pytest

from corpusloom import fixtures as fx
from corpusloom.catalog import QUERIES
from corpusloom.operators import judging, reports, winners
from corpusloom.operators.cleaning import fix_examples
from corpusloom.operators.planning import cap_per_category
from corpusloom.plans import judging_flow
from corpusloom.session import stage, work_dir

SF_DIR = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["x2_json_records", "x13_verdicts"])
def test_a_response_is_parsed_once(spark, name):
    assert optimized(QUERIES[name](spark, SF_DIR)).count("parseJson") == 1


@pytest.mark.parametrize("name", ["x12_first_ok", "e3_batched", "e1_sectioned", "j5_resume"])
def test_winners_are_found_by_narrow_columns(spark, monkeypatch, name):
    """Texts are parsed on the way to one table; neither then nor later are they sorted or carried by an aggregation."""
    plans = []
    write = winners.stage

    def spy(df, *more):
        plans.append(df)
        return write(df, *more)

    monkeypatch.setattr(winners, "stage", spy)
    plans.append(QUERIES[name](spark, SF_DIR))
    assert len(plans) >= 2 and optimized(plans[-1]).count("parseJson") == 0
    if name in ("x12_first_ok", "e3_batched"):
        assert optimized(plans[0]).count("parseJson") == 1
    for plan in map(physical, plans):
        assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_cap_limits_ahead_of_the_shuffle(spark):
    plan = physical(cap_per_category(fx.document_plan(spark, SF_DIR)))
    limits = [m.start() for m in re.finditer("WindowGroupLimit", plan)]
    assert len(limits) >= 2 and "Exchange" in plan[limits[0] : limits[1]]


@pytest.mark.parametrize("name", ["p5_status", "r7_progress"])
def test_counting_reads_no_texts(spark, name):
    assert not re.search(r"ReadSchema: struct<[^>]*\btext:", physical(QUERIES[name](spark, SF_DIR)))


@pytest.mark.parametrize("name", ["j4_attach", "r1_summary", "r2_by_category"])
def test_texts_are_read_once(spark, name):
    assert len(re.findall(r"ReadSchema: struct<[^>]*\btext:", physical(QUERIES[name](spark, SF_DIR)))) == 1


@pytest.fixture(scope="module")
def judged(spark):
    rows = judging_flow.judged_examples(fx.examples(spark, SF_DIR), fx.judge_responses(spark, SF_DIR))
    return stage(rows, work_dir(spark, "judged"), "verdict")


def test_reports_read_narrow_columns(judged):
    schema = re.search(r"ReadSchema: (struct<[^>]*>)", physical(reports.pass_rate_by_category(judged))).group(1)
    assert schema == "struct<category:string>"
    schema = re.search(r"ReadSchema: (struct<[^>]*>)", physical(reports.qc_summary(judged))).group(1)
    assert schema == "struct<avg_score:double>"


def test_split_prunes_partitions_and_does_not_shuffle(judged):
    plan = physical(judging.accepted(judged))
    assert re.search(r"PartitionFilters: \[.*verdict.* = accept", plan) and "Exchange" not in plan


def test_per_row_jobs_do_not_shuffle(spark):
    docs = fx.as_components(fx.table(spark, SF_DIR, "documents"))
    assert "Exchange" not in physical(fix_examples(docs))
