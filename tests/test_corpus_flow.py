"""Whole generation runs: resumed, parsed lazily, counted."""

import json

from helpers import frame
from pyspark.sql import functions as F

from corpusloom.operators.winners import winning_rows
from corpusloom.plans import corpus_flow as C
from corpusloom.session import own_tables, stage, work_dir
from corpusloom.sources import jsonl, manifest

LONG = "x" * 201
RESPONSES = "call_id string, stage int, attempt int, raw string"


def answer(*outputs):
    return json.dumps([{"instruction": "i", "output": o, "extra": 1} for o in outputs])


def plan(spark, *ids):
    return frame(spark, "call_id string, ordinal int, filename string", *[(c, k, f"f{k % 2}.jsonl") for k, c in enumerate(ids)])


def held(done):
    return sorted((r["call_id"], r["pos"], len(r["output"])) for r in done.records.collect())


def test_only_open_calls_are_parsed(spark):
    """Six answers to each of ten calls: one of each is looked into, two of one call."""
    rows = [(f"c{k}", s, a, answer(LONG + "y" * (3 * s + a))) for k in range(10) for s in (0, 1) for a in (1, 2, 3)]
    rows[0] = ("c0", 0, 1, "sorry")
    out = work_dir(spark, "calls")
    done = C.call_corpus(plan(spark, *[f"c{k}" for k in range(10)]), frame(spark, RESPONSES, *rows), out, C.batch_family("m"))
    assert done.parsed == 11
    assert held(done) == sorted((f"c{k}", 0, 203 if k == 0 else 202) for k in range(10))
    assert done.open_calls.count() == 0
    # all are finished: a second run looks into nothing
    again = C.call_corpus(plan(spark, *[f"c{k}" for k in range(10)]), frame(spark, RESPONSES, *rows), out, C.batch_family("m"))
    assert again.parsed == 0 and held(again) == held(done)


def test_fallback_open_calls_and_resumption(spark):
    out, family = work_dir(spark, "calls"), C.batch_family("m")
    rows = [("a", 1, 1, answer(LONG, LONG + "z")), ("b", 0, 1, "no"), ("c", 0, 2, answer(LONG)), ("unplanned", 0, 1, answer(LONG)), (None, 0, 1, answer(LONG))]
    first = C.call_corpus(plan(spark, "a", "b", "c"), frame(spark, RESPONSES, *rows), out, family)
    assert held(first) == [("a", 0, 201), ("a", 1, 202), ("c", 0, 201)]
    assert [r["call_id"] for r in first.open_calls.collect()] == ["b"]
    # a file is listed once per planned call that exists in it
    assert sorted((r["ordinal"], r["filename"], r["n"]) for r in first.files.where("is_total = 0").collect()) == [(0, "f0.jsonl", 3), (2, "f0.jsonl", 3)]
    tagged = json.loads(first.records.where("call_id = 'c'").first()["record"])
    assert tagged["category"] == "c" and tagged["type"] == "m" and tagged["extra"] == 1
    later = frame(spark, RESPONSES, ("a", 0, 1, answer("never " + LONG)), ("b", 0, 1, answer(LONG)))
    second = C.call_corpus(plan(spark, "a", "b", "c"), later, out, family)
    assert second.parsed == 1 and held(second) == [("a", 0, 201), ("a", 1, 202), ("b", 0, 201), ("c", 0, 201)]


def test_an_empty_list_ends_a_call(spark):
    rows = [("domain_x-1", 0, 1, "no"), ("domain_x-1", 0, 2, "[]"), ("domain_x-1", 0, 3, answer(LONG)), ("g-2", 0, 1, answer("one", " "))]
    done = C.call_corpus(plan(spark, "domain_x-1", "g-2", "g-3"), frame(spark, RESPONSES, *rows), work_dir(spark, "calls"), C.object_family())
    assert [(r["call_id"], r["output"], r["category"], r["type"]) for r in done.records.collect()] == [("g-2", "one", "g", "generic")]
    assert [r["call_id"] for r in done.open_calls.collect()] == ["g-3"] and done.parsed == 3


def section(prompt, ok=True):
    return f"=== INSTRUCTION ===\n{prompt}\n=== HTML ===\n{LONG}\n=== {'JS' if ok else 'J'} ===\nconst a = 1;\n=== CSS ===\nNONE\n"


def test_a_sectioned_corpus_goes_on_from_its_own_log(spark):
    grid = frame(spark, "category string, ordinal int, prompt string, domain string", *[("A", k, f"p{k}", None) for k in range(5)], ("B", 0, "q0", "D"))
    rows = [(f"p{k}", a, section(f"p{k}", ok=a > k)) for k in range(5) for a in (1, 2, 3)] + [("q0", 1, section("q0"))]
    responses = frame(spark, "prompt string, attempt int, raw string", *rows)
    one, two = work_dir(spark, "corpus"), work_dir(spark, "corpus")
    first = C.sectioned_corpus(grid, responses.where("prompt <> 'p1'"), one, target=4)
    # p3 never succeeds, p4 is beyond the target
    assert (first.new, first.earlier) == (3, 0)
    assert sorted(r["prompt"] for r in first.final.collect()) == ["p0", "p2", "q0"]
    assert {(r["category"], r["n"], r["short"]) for r in first.shortfall.collect()} == {("A", 2, 2), ("B", 1, 3)}
    assert {(r["category"], r["done"], r["remaining"]) for r in first.status.collect()} == {("A", 2, 2), ("B", 1, 0)}

    for log in (
        jsonl.tolerant_log(spark.read.text(f"{one}/part=log")),
        jsonl.strict_log(spark, f"{one}/part=log", jsonl.SECTIONED),
    ):
        second = C.sectioned_corpus(grid, responses, two, log, target=4)
        assert (second.new, second.earlier) == (1, 3)
        got = sorted((r["prompt"], r["domain"], r["source"]) for r in second.final.collect())
        assert got == [(p, d, f"synthetic_lwc_master/{c}") for p, d, c in (("p0", "Generic", "a"), ("p1", "Generic", "a"), ("p2", "Generic", "a"), ("q0", "D", "b"))]
        assert [json.loads(r["value"])["prompt"] for r in spark.read.text(f"{two}/part=log").collect()] == ["p1"]


def test_a_run_without_results(spark):
    grid = frame(spark, "category string, ordinal int, prompt string, domain string", ("A", 0, "p", None))
    responses = frame(spark, "prompt string, attempt int, raw string", ("p", 1, "no"))
    out = work_dir(spark, "corpus")
    done = C.sectioned_corpus(grid, responses, out)
    assert done.new == 0 and done.final.count() == 0 and done.status.first()["remaining"] == 1 and done.shortfall.count() == 0


def test_winning_rows(spark):
    rows = frame(spark, "k string, o long, v string", ("a", 2, "second"), ("a", 1, "first"), ("b", None, "only"), (None, 5, "null key"), ("c", 3, "tie"), ("c", 3, "tie"))
    got = winning_rows(rows, ["k"], F.col("o"), count="n")
    assert sorted(((r["k"] or ""), r["v"], r["n"]) for r in got.collect()) == [("", "null key", 1), ("a", "first", 2), ("b", "only", 1), ("c", "tie", 2)]


def test_owned_tables_are_deleted(spark):
    with own_tables(spark):
        with own_tables(spark):
            inner = work_dir(spark, "inner")
            stage(spark.range(3), inner)
        outer = work_dir(spark, "outer")
        stage(spark.range(3), outer)
        assert not manifest.exists(spark, inner) and manifest.is_whole(spark, outer)
    assert not manifest.exists(spark, outer)
    kept = work_dir(spark, "kept")
    stage(spark.range(3), kept)
    assert manifest.is_whole(spark, kept)
