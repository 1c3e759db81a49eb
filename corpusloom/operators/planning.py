"""Building the work table: prompt grids, caps, what is left to do, rewrites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import WS, render, render_each, strip
from corpusloom.operators.skew import lookup_join
from corpusloom.session import stage, work_dir

# Sizes and texts that decide the rendered prompts.
TARGET_PER_CATEGORY = 40
ONE_EXAMPLE_NOTE = (
    "\n\nIMPORTANT: Output EXACTLY 1 example (JSON array with ONE object). "
    "100% complete, compilable, no truncation."
)
FORMAT_REMINDER = (
    "\n\nRespond using EXACTLY this format — no prose before or after:\n"
    "=== INSTRUCTION ===\n<one sentence>\n"
    "=== HTML ===\n<html>\n"
    "=== JS ===\n<js>\n"
    "=== CSS ===\n<css or NONE>"
)

CAP_SALTS = 64
# Places of a category that a task unfolds at a time.
GRID_PART = 1 << 16


def numbered(df: DataFrame, order: str, name: str = "position") -> DataFrame:
    """Rows numbered from 0 in the order of a column, without gathering them.

    The table is written in ranges; numbers inside a range are added to the
    sizes of the ranges before it, of which there are as many as tasks.
    """
    spark = df.sparkSession
    ranges = stage(df.repartitionByRange(order).withColumn("_range", F.spark_partition_id()), work_dir(spark, "numbered"))
    inside = ranges.withColumn("_row", F.row_number().over(Window.partitionBy("_range").orderBy(order, *df.columns)) - 1)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return inside.join(offsets, "_range").withColumn(name, F.col("_offset") + F.col("_row")).drop("_range", "_row", "_offset")


def prompt_grid(
    categories: DataFrame, domains: DataFrame, domain_order: str = "name", per_category: int | None = None
) -> DataFrame:
    """All prompts of every category, numbered in plan order, or the first ``per_category`` of each.

    ``categories``: category, max_tokens, generic_prompts, domain_template,
    variations. A category without variations has its generic prompts only.
    ``domains``: name, objects, context, examples. Of the domains only their
    number reaches a category row; it unfolds into places, GRID_PART of them in a
    task, and each place looks up its domain by position. Places beyond the cap
    never come into being.
    """
    base = F.size("generic_prompts").cast("long")
    generic = categories.select(
        "category",
        "max_tokens",
        F.posexplode("generic_prompts").alias("ordinal", "prompt"),
        F.lit("Generic").alias("domain"),
    ).withColumn("ordinal", F.col("ordinal").cast("long"))
    if per_category is not None:
        generic = generic.where(F.col("ordinal") < per_category)
    kinds = F.size("variations").cast("long")
    places = domains.agg(F.count(F.lit(1)).alias("n")).scalar() * kinds
    if per_category is not None:
        places = F.least(places, F.lit(per_category) - base)
    # in two steps, with the parts dealt out between them: a category with very many places is unfolded by many tasks
    parts = categories.where(F.size("variations") > 0).select(
        "category", "max_tokens", "domain_template", "variations", base.alias("base"), places.alias("places"),
    )
    parts = parts.withColumn("part", F.explode(F.when(F.col("places") > 0, F.sequence(F.lit(0).cast("long"), F.col("places") - 1, F.lit(GRID_PART)))))
    parts = parts.repartition(int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions")), "category", "part")
    unfolded = parts.withColumn("place", F.explode(F.sequence("part", F.least(F.col("part") + GRID_PART, F.col("places")) - 1)))
    unfolded = unfolded.select(
        "category", "max_tokens", "domain_template", (F.col("base") + F.col("place")).alias("ordinal"),
        F.floor(F.col("place") / kinds).cast("long").alias("position"),
        F.get("variations", (F.col("place") % kinds).cast("int")).alias("variation"),
    )
    dom = F.struct("name", "objects", "context", "examples").alias("dom")
    placed = numbered(domains.select(*dict.fromkeys((domain_order, "name", "objects", "context", "examples"))), domain_order, "_place")
    placed = placed.select(F.col("_place").alias("position"), dom)
    per_domain = unfolded.join(placed, "position").select(
        "category",
        "max_tokens",
        "ordinal",
        render_domain_prompt(F.col("domain_template"), F.col("dom"), F.col("variation")).alias("prompt"),
        F.col("dom.name").alias("domain"),
    )
    return generic.unionByName(per_domain)


def render_domain_prompt(template: Column, dom: Column, variation: Column) -> Column:
    return render_each(
        template,
        {
            "domain_name": dom["name"],
            "context": dom["context"],
            "examples": dom["examples"],
            "objects": dom["objects"],
            "variation": variation,
        },
    )


def cap_per_category(
    plan: DataFrame, n: int = TARGET_PER_CATEGORY, by: str = "category", order: str = "ordinal", salts: int = CAP_SALTS
) -> DataFrame:
    """The first ``n`` rows of each category in plan order.

    A salted first round keeps ``n`` rows of every part of a category, so no
    category reaches one task whole, however large ``n`` is.
    """
    salt = F.pmod(F.xxhash64(order), F.lit(salts))
    first = Window.partitionBy(by, salt).orderBy(order)
    plan = plan.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= n).drop("_rank")
    rank = F.row_number().over(Window.partitionBy(by).orderBy(order))
    return plan.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def remaining_work(plan: DataFrame, done: DataFrame, key: str, unique: bool = False) -> DataFrame:
    """Plan rows whose key is not done.

    The done keys are made distinct first: a key finished many times crosses
    the shuffle once per task. ``unique`` says that no key repeats in the plan;
    otherwise the distinct keys are written out, so that a prompt planned very
    often can be split.
    """
    finished = done.select(key).distinct()
    return plan.join(finished, key, "left_anti") if unique else lookup_join(plan, finished, key, "left_anti")


def plan_status(
    plan: DataFrame, results: DataFrame, remaining: DataFrame, target: int = TARGET_PER_CATEGORY
) -> DataFrame:
    """Per planned category: done, remaining and whether the target is met.

    One aggregation over the three tables; categories nobody planned drop out.
    """
    def tagged(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            "category", *[F.lit(int(c == name)).alias(c) for c in ("planned", "done", "remaining")]
        )

    rows = tagged(plan, "planned").unionByName(tagged(results, "done")).unionByName(tagged(remaining, "remaining"))
    return (
        rows.groupBy("category")
        .agg(*[F.sum(c).alias(c) for c in ("planned", "done", "remaining")])
        .where(F.col("planned") > 0)
        .select("category", "done", "remaining", (F.col("done") >= target).alias("complete"))
    )


def progress(plan: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """One row: planned rows, distinct finished keys, planned rows still to do.

    Keys finished but no longer planned count as done, as in a resumed log.
    """
    finished = done.agg(F.countDistinct(key).alias("done")).scalar()
    to_do = remaining_work(plan, done, key).agg(F.count(F.lit(1)).alias("to_do")).scalar()
    total = plan.agg(F.count(F.lit(1)).alias("total"))
    return total.select("total", finished.alias("done"), to_do.alias("to_do"))


def force_one(prompt: Column) -> Column:
    """Ask for one example only."""
    asked = F.regexp_replace(prompt, rf"(?iU)\bGenerate{WS}+\d+\b", "Generate 1")
    return F.concat(asked, F.lit(ONE_EXAMPLE_NOTE))


def fallback_prompt(prompt: Column) -> Column:
    """Ask for five examples after a full batch failed.

    A prompt with words between the number and "training examples" keeps its
    number, and only the second phrase is rewritten.
    """
    fewer = F.regexp_replace(prompt, r"(?U)Generate \d+ training examples", "Generate 5 training examples")
    return F.regexp_replace(fewer, r"(?U)Cover these \d+ ", "Cover 5 of these ")


def with_fallback(plan: DataFrame, prompt: str = "prompt") -> DataFrame:
    return plan.withColumn("fallback_prompt", fallback_prompt(F.col(prompt))).withColumn(
        "changed", ~F.col("fallback_prompt").eqNullSafe(F.col(prompt))
    )


def judge_prompt(
    template: str, instruction: Column, output: Column, instruction_chars: int | None = None, output_chars: int | None = None
) -> Column:
    """The template with the whole instruction and output, or as much of them as a judge is to be shown."""

    def shown(text: Column, chars: int | None) -> Column:
        text = F.coalesce(text, F.lit(""))
        return text if chars is None else F.left(text, F.lit(chars))

    return render(template, instruction=shown(instruction, instruction_chars), output=shown(output, output_chars))


def envelope(system: str | Column, prompt: Column, suffix: str = "", strip_prompt: bool = False) -> Column:
    """System and user message, in this order."""
    system = F.lit(system) if isinstance(system, str) else system
    content = strip(prompt) if strip_prompt else prompt
    if suffix:
        content = F.concat(content, F.lit(suffix))
    return F.array(
        F.struct(F.lit("system").alias("role"), system.alias("content")),
        F.struct(F.lit("user").alias("role"), content.alias("content")),
    )
