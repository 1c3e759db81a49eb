from helpers import frame
from pyspark.sql import functions as F

from corpusloom.operators import formats as M
from corpusloom.operators import lint

EXAMPLE = "instruction string, input string, output string, category string, subcategory string, difficulty string, tags array<string>"


def test_validation(spark):
    df = frame(spark, EXAMPLE, ("i", "", "o", "apex", "s", "beginner", ["t"]), ("i", None, "o", "misc", "s", "hard", None))
    assert [r["violations"] for r in M.with_violations(df).collect()] == [
        [], ["missing input", "missing tags", "unknown category", "unknown difficulty"]]


def test_validation_of_a_missing_column(spark):
    df = frame(spark, EXAMPLE, ("i", "", "o", "apex", "s", "beginner", ["t"])).drop("tags")
    assert M.with_violations(df).first()["violations"] == ["missing tags"]


def test_chat_is_ordered(spark):
    turns = frame(spark, "conv_id int, turn int, role string, text string", (1, 2, "assistant", "c"), (1, 0, "system", "a"), (1, 1, "user", "b"))
    row = M.assemble_chat(turns.repartition(3)).first()
    assert [tuple(m) for m in row["messages"]] == [("system", "a"), ("user", "b"), ("assistant", "c")]


def test_chat_check(spark):
    rows = [(1, 0, "system", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"),
            (2, 5, "user", " "), (2, 7, "user", "x"), (2, 9, "system", "y"), (2, 11, "robot", None), (2, 13, None, "z")]
    df = frame(spark, "conv_id int, turn int, role string, text string", *rows)
    got = {r["conv_id"]: r.asDict() for r in M.check_chat(df).collect()}
    assert got[1]["ok"] and got[1]["turns"] == 3
    assert {k: got[2][k] for k in ("bad_roles", "blank_turns", "late_systems", "repeats", "ok")} == {
        "bad_roles": 2, "blank_turns": 2, "late_systems": 1, "repeats": 1, "ok": False}


def test_chat_conversion(spark):
    df = frame(spark, "instruction string, input string, output string", ("i", "", "o"), ("i", "ctx", "o"))
    chat = M.to_chat(df)
    assert [[tuple(m) for m in r["messages"]] for r in chat.collect()] == [
        [("user", "i"), ("assistant", "o")], [("user", "i\n\nctx"), ("assistant", "o")]]
    back = M.from_chat(chat.select("messages")).first()
    assert (back["instruction"], back["output"], back["system"]) == ("i", "o", None)


def test_unify(spark):
    one = frame(spark, "prompt string, completion string, category string, domain string", ("p", "c", "A", "D"))
    two = frame(spark, "instruction string, input string, output string, category string", ("i", "in", "o", "B"))
    got = sorted(map(tuple, M.unify(one, two).select("instruction", "output", "input", "category", "domain").collect()))
    assert got == [("i", "o", "in", "B", "Generic"), ("p", "c", "", "A", "D")]


def test_coverage(spark):
    targets = frame(spark, "category string, target long", ("a", 2), ("b", 1))
    got = {tuple(r) for r in M.coverage(frame(spark, "category string", ("a",), ("z",)), targets).collect()}
    assert got == {("a", 2, 1, 1), ("b", 1, 0, 1)}


def test_tags(spark):
    df = frame(spark, "tags array<string>", (["b", "a"],), (["a"],), ([],), (None,), (["c"],))
    assert [tuple(r) for r in M.tag_frequency(df, 2).collect()] == [("a", 2), ("b", 1)]


def test_lint(spark):
    texts = {
        "placeholder": "// TODO", "missing_sharing": "public class A {}", "no_security": "[SELECT Id FROM A]",
        "hardcoded_id": "x = '001000000000001AAA';", "trivial_assert": "System.assert(true);", "deprecated_if": "<t if:true={a}>",
        "inline_style": "<p style='x'>", "none": "public without sharing class A { a = [SELECT Id FROM A WITH SECURITY_ENFORCED]; }",
    }
    hits = lint.lint(spark.createDataFrame(list(texts.items()), "id string, output string"), "id").where("hit")
    assert {(r["id"], r["rule"]) for r in hits.collect()} == {(k, k) for k in texts if k != "none"}
    assert [r[0] for r in lint.RULES] == [k for k in texts if k != "none"]
    assert hits.select(F.countDistinct("rule")).first()[0] == 7
