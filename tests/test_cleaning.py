from helpers import evaluate, frame
from pyspark.sql import functions as F

from corpusloom.operators import cleaning as C


def test_track(spark):
    got = evaluate(spark, ["@track a = 1;\n@track b = [];\n@track  c='x';", "@track été = null ;", "@track o = {};"], C.untrack_primitives)
    assert got == ["a = 1;\n@track b = [];\nc='x';", "été = null ;", "@track o = {};"]


def test_loading(spark):
    field, getter = "class A {\n    isLoading = true;\n", "    get isLoading() {}\n"
    got = evaluate(spark, [field + getter, field, "class A {\n  isLoading = true;\n" + getter], C.drop_loading_field)
    assert got == ["class A {\n" + getter, field, "class A {\n  isLoading = true;\n" + getter]


def test_css(spark):
    got = evaluate(spark, ["/* a.css */\n```css\n:host{}\n```\nrest", "```css\nx\n```"], C.unfence_css)
    assert got == ["/* a.css */\n:host{}\nrest", "```css\nx\n```"]


def test_header_is_not_idempotent(spark):
    line = "<!-- a.html -->\n"
    assert evaluate(spark, [line * 3, line * 2, line], C.merge_headers) == [line * 2, line, line]


def test_fix_flags(spark):
    df = frame(spark, "output string", ("@track a = 1;",), ("plain",))
    got = {r["output"]: r["track_changed"] for r in C.fix_examples(df, changed=True).collect()}
    assert got == {"a = 1;": True, "plain": False}


def test_bad_tests(spark):
    df = frame(spark, "instruction string, output string",
               ("Write Jest tests", "it('x')"), ("write TESTS FOR a", "submit('x')"), ("build", "none"), (None, "none"))
    assert sorted(r["output"] for r in C.drop_bad_tests(df).collect()) == ["it('x')", "none", "none"]


def test_slug(spark):
    got = evaluate(spark, ["Dynamic Components (lwc:is)", "Events & Communication", "A/B c"], C.slug)
    assert got == ["dynamic_components_lwc:is", "events_&_communication", "a_b_c"]


def test_derive(spark):
    df = frame(spark, "call_id string", ("a-b-domain",), ("plain",), ("mydomain",), ("-x",))
    got = {r["call_id"]: (r["category"], r["type"]) for r in C.derive_from_call(df).collect()}
    assert got == {"a-b-domain": ("a", "domain"), "plain": ("plain", "generic"), "mydomain": ("mydomain", "domain"), "-x": ("", "generic")}


def test_union_keeps_duplicates(spark):
    df = frame(spark, "a int", (1,))
    assert C.union_results(df, df.withColumn("b", F.lit("x"))).count() == 2
