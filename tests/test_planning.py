import pytest
from helpers import evaluate, frame
from pyspark.sql import functions as F

from corpusloom.operators import planning as P


def templates(spark):
    schema = "category string, max_tokens int, generic_prompts array<string>, domain_template string, variations array<string>"
    return frame(spark, schema,
                 ("A", 7000, ["g0", "g1"], "{domain_name}|{context}|{examples}|{objects}|{variation}", ["v0", "v1"]),
                 ("Gap", 9000, ["h0", "h1", "h2"], None, []))


def domains(spark):
    return frame(spark, "pos int, name string, objects string, context string, examples string",
                 (2, "Last", "o2", "c2", "e2"), (1, "First", "o1", "{variation}", "e1"))


def test_grid(spark):
    got = [tuple(r) for r in P.prompt_grid(templates(spark), domains(spark), "pos").orderBy("category", "ordinal").select("category", "ordinal", "prompt", "domain").collect()]
    assert got == [
        ("A", 0, "g0", "Generic"), ("A", 1, "g1", "Generic"),
        ("A", 2, "First|{variation}|e1|o1|v0", "First"), ("A", 3, "First|{variation}|e1|o1|v1", "First"),
        ("A", 4, "Last|c2|e2|o2|v0", "Last"), ("A", 5, "Last|c2|e2|o2|v1", "Last"),
        ("Gap", 0, "h0", "Generic"), ("Gap", 1, "h1", "Generic"), ("Gap", 2, "h2", "Generic"),
    ]


def test_grid_size_of_a_full_corpus(spark):
    """19 categories of 8 + 8 x 4 prompts and 6 of 40 hand-made ones."""
    full = spark.range(25).select(
        F.concat(F.lit("c"), "id").alias("category"), F.lit(1).alias("max_tokens"),
        F.transform(F.sequence(F.lit(1), F.when(F.col("id") < 19, 8).otherwise(40)), lambda i: i.cast("string")).alias("generic_prompts"),
        F.lit("{domain_name} {variation}").alias("domain_template"),
        F.when(F.col("id") < 19, F.array(*[F.lit(v) for v in "abcd"])).otherwise(F.array().cast("array<string>")).alias("variations"),
    )
    eight = spark.range(8).select(F.col("id").alias("pos"), *[F.col("id").cast("string").alias(c) for c in ("name", "objects", "context", "examples")])
    plan = P.prompt_grid(full, eight, "pos")
    assert plan.count() == 1000
    assert P.cap_per_category(plan).count() == 1000
    assert P.cap_per_category(plan, 7).count() == 25 * 7


def test_no_cross_join(spark):
    plan = P.prompt_grid(templates(spark), domains(spark), "pos")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_many_domains_and_a_cap_ahead_of_the_grid(spark):
    many = spark.range(10_001).select(
        F.col("id").alias("pos"), *[F.concat(F.lit(f"{c}-"), F.lpad("id", 5, "0")).alias(c) for c in ("name", "objects", "context", "examples")]
    )
    grid = P.prompt_grid(templates(spark), many, "pos")
    kinds = templates(spark).agg(F.sum(F.size("variations")), F.sum(F.size("generic_prompts"))).first()
    assert grid.count() == 10_001 * kinds[0] + kinds[1]
    capped = P.prompt_grid(templates(spark), many, "pos", 5_000)
    want = grid.where("ordinal < 5000")
    assert capped.exceptAll(want).count() == 0 and want.exceptAll(capped).count() == 0
    assert P.cap_per_category(grid, 5_000).count() == capped.count()


def test_numbered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("k"))
    rows = P.numbered(df, "k").orderBy("k").collect()
    assert [r["position"] for r in rows] == list(range(1000))


@pytest.mark.parametrize("threshold", ["1000", "3"])
def test_cap_same_with_and_without_group_limit(spark, threshold):
    plan = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 7)).alias("category"),
                                    (3000 - F.col("id")).alias("ordinal"))
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", threshold)
    try:
        got = {tuple(r) for r in P.cap_per_category(plan, 5).collect()}
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    rows = sorted((o, c) for c, o in (tuple(r) for r in plan.collect()))
    want, seen = set(), {}
    for o, c in rows:
        seen[c] = seen.get(c, 0) + 1
        if seen[c] <= 5:
            want.add((c, o))
    assert got == want


@pytest.mark.parametrize("unique", [True, False])
def test_remaining(spark, unique):
    plan = frame(spark, "k string, n int", ("a", 1), ("b", 2), ("c", 3), (None, 4))
    done = frame(spark, "k string", ("b",), ("b",), ("z",))
    left = P.remaining_work(plan, done, "k", unique)
    assert sorted(r["n"] for r in left.collect()) == [1, 3, 4]
    # done and remaining make up the plan
    assert left.count() + plan.join(done.distinct(), "k", "left_semi").count() == plan.count()


def test_status_lists_every_planned_category(spark):
    plan = frame(spark, "category string", ("a",), ("a",), ("b",))
    results = frame(spark, "category string", ("a",), ("a",), ("x",))
    got = {tuple(r) for r in P.plan_status(plan, results, frame(spark, "category string", ("b",)), target=2).collect()}
    assert got == {("a", 2, 0, True), ("b", 0, 1, False)}


def test_progress(spark):
    plan = frame(spark, "k int", (1,), (2,), (3,))
    done = frame(spark, "k int", (2,), (2,), (9,))
    assert P.progress(plan, done, "k").first().asDict() == {"total": 3, "to_do": 2, "done": 2}


def test_force_one(spark):
    got = evaluate(spark, ["Generate 10 x and generate\n5 y", "regenerate 3"], P.force_one)
    assert got == ["Generate 1 x and Generate 1 y" + P.ONE_EXAMPLE_NOTE, "regenerate 3" + P.ONE_EXAMPLE_NOTE]


def test_fallback(spark):
    df = frame(spark, "prompt string", ("Generate 10 training examples. Cover these 10 topics",),
               ("Generate 10 more training examples",), ("Generate 10 more training examples. Cover these 8 ",))
    got = {r["prompt"]: (r["fallback_prompt"], r["changed"]) for r in P.with_fallback(df).collect()}
    assert list(got.values()) == [
        ("Generate 5 training examples. Cover 5 of these topics", True),
        ("Generate 10 more training examples", False),
        ("Generate 10 more training examples. Cover 5 of these ", True),
    ]


def test_judge_prompt_cuts_by_characters(spark):
    got = evaluate(spark, ["😀" * 4000, None], lambda c: P.judge_prompt("{instruction}|{output}", c, c, 800, 3000))
    assert got == ["😀" * 800 + "|" + "😀" * 3000, "|"]


def test_envelope(spark):
    got = evaluate(spark, [" p\n"], lambda c: P.envelope("s", c, suffix="!", strip_prompt=True))[0]
    assert [tuple(m) for m in got] == [("system", "s"), ("user", "p!")]


def test_places_of_one_category_are_unfolded_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(P, "GRID_PART", 100)
    categories = frame(
        spark, "category string, max_tokens long, generic_prompts array<string>, domain_template string, variations array<string>",
        ("A", 1, ["g"], "{domain_name} {variation}", ["u", "v"]),
    )
    domains = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("name"), *[F.lit("x").alias(c) for c in ("objects", "context", "examples")])
    grid = P.prompt_grid(categories, domains)
    got = {r["ordinal"]: r["prompt"] for r in grid.collect()}
    assert got == {0: "g"} | {1 + 2 * d + v: f"{d:04d} {'uv'[v]}" for d in range(1000) for v in (0, 1)}
    unfolding = P.prompt_grid(categories, domains)._jdf.queryExecution().optimizedPlan().toString()
    assert unfolding.count("Generate explode") == 2 and "RepartitionByExpression" in unfolding
