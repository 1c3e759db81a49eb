import json

import pytest
from helpers import evaluate, frame
from pyspark.sql import functions as F

from corpusloom.functions import strict_json as J
from corpusloom.operators import responses as R
from corpusloom.plans import generation_flow

LONG = "x" * 201
STRICT = {
    '{"a":1} tail': False, "{'a':1}": False, '{"a":1,}': False, '{"a":1}, {"b":2}': False, '{"a":1}] tail': False,
    "[1]] x [2]": False, "": False, " ": False, "nul": False, '"a\nb"': False, r'"\1"': False, "01": False,
    '{"a":1,"a":2}': True, "null": True, "3": True, ' [1, {"b": []}] \n': True, '"\\ud83d\\ude00"': True, "1e3": True,
}


def test_strict_json_as_python(spark):
    for text, ok in STRICT.items():
        try:
            json.loads(text)
            assert ok, text
        except json.JSONDecodeError:
            assert not ok, text
    df = spark.createDataFrame([(t,) for t in [*STRICT, None]], "s string")
    got = {r["s"]: r["ok"] for r in J.with_json(df, "s", "v").select("s", F.col("v").isNotNull().alias("ok")).collect()}
    assert got == {**STRICT, None: False}


def test_last_duplicate_key_wins(spark):
    df = J.with_json(frame(spark, "s string", ('{"a":1,"a":2}',)), "s", "v")
    assert df.select(F.to_json("v")).first()[0] == '{"a":2}'


def test_reasoning(spark):
    got = evaluate(spark, ["<think>a\nb</think>\n x ", "<think>a</think>b<think>c</think>", "<think>open"], R.strip_reasoning)
    assert got == ["x", "b", "<think>open"]


@pytest.mark.parametrize("mode, want", [
    ("faithful", ["a\\\\sb", "a\\\\\\sb", "a\\1b", "a\\nb", "end\\\\", "\\\\d\\\\w"]),
    ("safe", ["a\\\\sb", "a\\\\sb", "a\\\\1b", "a\\nb", "end\\\\", "\\\\d\\\\w"]),
])
def test_escapes(spark, mode, want):
    values = ["a\\sb", "a\\\\sb", "a\\1b", "a\\nb", "end\\", "\\d\\w"]
    assert evaluate(spark, values, lambda c: R.repair_escapes(c, mode)) == want


# Input, then what each family makes of it, blanks at the ends aside.
CLEAN = [
    ("", "", "", ""),
    (" [1] \n", "[1]", "[1]", "[1]"),
    ("```", "", "", ""),
    ("```json\n[1]\n```", "[1]", "[1]", "[1]"),
    ("```\n[1]\n```\n", "[1]", "[1]", "[1]"),
    ("```json\n[1]\n```\nafter\n```\n", "[1]", "[1]\nafter", "[1]\nafter"),
    ("before\n```json\n{}\n```", "before\n```json\n{}", "{}", "before\n{}"),
    ("x ```json {} ```  ``` y", "x ```json {} ```  ``` y", "{}", "x ```json {} ```  ``` y"),
    ("``````json", "```json", "```json", "```json"),
    ("a [1] b [2] c", "[1] b [2]", "a [1] b [2] c", "a [1] b [2] c"),
    ("a {1} b {2} c", "a {1} b {2} c", "{1} b {2}", "a {1} b {2} c"),
    ("] [", "] [", "] [", "] ["),
    ("<think>[0]</think> [1]", "[1]", "<think>[0]</think> [1]", "<think>[0]</think> [1]"),
    ("a\r```", "a", "a", "a"),
    ("\u2028```json [1]", "[1]", "[1]", "[1]"),
    ("a\u2028```json [1]", "[1]", "a\u2028```json [1]", "a\u2028```json [1]"),
]


@pytest.mark.parametrize("place, family", [(1, "batch"), (2, "judge"), (3, "object")])
def test_clean_variants(spark, place, family):
    df = spark.createDataFrame([(c[0],) for c in CLEAN], "raw string")
    got = {r["raw"]: r["out"].strip() for r in R.with_clean_json(df, "raw", "out", family).collect()}
    assert got == {c[0]: c[place] for c in CLEAN}


BATCH = {
    "two good": ([{"instruction": "i", "output": LONG, "k": 1}, {"instruction": "j", "output": LONG, "input": "in"}], 2),
    "short one left out": ([{"instruction": "i", "output": LONG}, {"instruction": "j", "output": "x" * 200}], 1),
    "missing key left out": ([{"output": LONG}, {"instruction": "i", "output": LONG}, {"instruction": "i"}], 1),
    "null output voids": ([{"instruction": "i", "output": LONG}, {"instruction": "j", "output": None}], None),
    "number output voids": ([{"instruction": "i", "output": 5}], None),
    "null output without instruction is left out": ([{"output": None}, {"instruction": "i", "output": LONG}], 1),
    "number element voids": ([3, {"instruction": "i", "output": LONG}], None),
    "null element voids": ([None, {"instruction": "i", "output": LONG}], None),
    "string element left out": (["plain", {"instruction": "i", "output": LONG}], 1),
    "string naming both keys voids": (["instruction and output", {"instruction": "i", "output": LONG}], None),
    "list naming both keys voids": ([["output", "instruction"], {"instruction": "i", "output": LONG}], None),
    "other list left out": ([["output"], {"instruction": "i", "output": LONG}], 1),
    "long list output counts items": ([{"instruction": "i", "output": [1] * 201}], 1),
    "empty list": ([], 0),
    "object": ({"instruction": "i", "output": LONG}, None),
}


def test_batch_attempts(spark):
    rows = [(name, json.dumps(value)) for name, (value, _) in BATCH.items()] + [("cut", '[{"instruction": "i"'), ("none", None)]
    df = R.batch_attempts(spark.createDataFrame(rows, "name string, raw string"))
    got = {r["name"]: r["n"] for r in df.select("name", F.when(F.col("records").isNotNull(), F.size("records")).alias("n")).collect()}
    assert got == {name: n for name, (_, n) in BATCH.items()} | {"cut": None, "none": None}


def test_batch_fields(spark):
    value = [{"output": "s"}, {"instruction": "i", "output": LONG, "tags": [1]}, {"instruction": "j", "output": LONG, "input": None}]
    df = frame(spark, "id int, raw string", (1, json.dumps(value)))
    rows = R.explode_records(R.batch_attempts(df), "id").orderBy("pos")
    got = rows.select("pos", "instruction", "input", R.open_record(F.col("record"), category=F.lit("C"), type=F.lit("t")).alias("open")).collect()
    assert [(r["pos"], r["instruction"], r["input"]) for r in got] == [(1, "i", ""), (2, "j", None)]
    assert json.loads(got[0]["open"]) == {"instruction": "i", "output": LONG, "tags": [1], "category": "C", "type": "t"}


def test_object_family(spark):
    one = {"instruction": "i", "input": "dropped", "output": "o"}
    rows = [
        ("ap-domain-1", 1, json.dumps(one)),
        ("ap-2", 1, "no json"), ("ap-2", 2, json.dumps([one, {"output": " \n"}])), ("ap-2", 3, json.dumps([one] * 3)),
        ("ap-3", 1, "[]"), ("ap-3", 2, json.dumps(one)),
        ("ap-4", 5, json.dumps(one)),
        ("solo", 1, json.dumps([{"output": "only"}, {"output": None, "instruction": "n"}, 7])),
        ("esc", 1, '{"instruction": "re", "output": "a\\s"}'),
    ]
    tries = spark.createDataFrame(rows, "call_id string, attempt int, raw string")
    got = {(r["call_id"], r["pos"]): (r["instruction"], r["input"], r["output"], r["category"], r["type"])
           for r in generation_flow.object_results(tries, max_attempts=4).collect()}
    assert got == {
        ("ap-domain-1", 0): ("i", "", "o", "ap", "domain"),
        ("ap-2", 0): ("i", "", "o", "ap", "generic"),
        ("solo", 0): ("", "", "only", "solo", "generic"),
        ("esc", 0): ("re", "", "a\\s", "esc", "generic"),
    }
    bad = R.quarantined(R.object_attempts(tries), "call_id").collect()
    assert {(r["call_id"], r["pos"], r["error"]) for r in bad} == {("solo", 1, "output is no text"), ("solo", 2, "element is no object")}


def test_first_acceptable_stages(spark):
    good = json.dumps([{"instruction": "i", "output": LONG}])
    rows = [("a", 0, 1, "x"), ("a", 0, 3, good), ("a", 1, 1, good), ("b", 1, 2, good), ("b", 0, 4, good), ("c", 0, 1, "[]")]
    tries = spark.createDataFrame(rows, "call_id string, stage int, attempt int, raw string")
    got = generation_flow.batch_results(tries, "migration").select("call_id", "category", "type").collect()
    # the attempt over the limit does not count for b, and c stays open
    assert sorted(map(tuple, got)) == [("a", "a", "migration"), ("b", "b", "migration")]


VERDICTS = {
    '{"completeness": 5, "alignment": 4, "best_practices": 3, "code_quality": 3, "verdict": "reject", "reason": "r"}': (5, 4, 3, 3),
    'Sure {"completeness": 5, "alignment": 4.5, "best_practices": 7, "code_quality": true, "verdict": 1, "reason": null} done': (5, 4.5, 7, 1),
    '{"completeness": "5", "alignment": 4, "best_practices": 3, "code_quality": 3, "verdict": "", "reason": "r"}': None,
    '{"completeness": null, "alignment": 4, "best_practices": 3, "code_quality": 3, "verdict": "", "reason": "r"}': None,
    '{"alignment": 4, "best_practices": 3, "code_quality": 3, "verdict": "", "reason": "r"}': None,
    '[1]': None, "5": None, "no": None,
    '{"completeness": 1} and {"completeness": 5}': None,
}


def test_verdict_attempts(spark):
    df = R.verdict_attempts(spark.createDataFrame([(k,) for k in VERDICTS], "raw string"))
    got = {r["raw"]: r["verdict"] and tuple(r["verdict"])[:4] for r in df.collect()}
    assert got == VERDICTS
