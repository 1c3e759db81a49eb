"""Prompt grids, caps, remaining work, rewrites and the injected model call."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import fixtures as fx
from corpusloom.catalog.sql import GRID
from corpusloom.inference import infer
from corpusloom.operators import planning as P

TEMPLATE = "Rate this.\n{instruction}\n---\n{output}\nAnswer as {{json}}."


def _grid(spark: SparkSession, sf_dir: str, per_category: int | None = None) -> DataFrame:
    return P.prompt_grid(fx.plan_categories(spark, sf_dir), fx.plan_domains(spark, sf_dir), "position", per_category)


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grid(spark, sf_dir).withColumn("ordinal", F.col("ordinal").cast("long"))


def render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A template per document, filled from the document's own columns."""
    template = F.concat(F.lit("For {domain_name} {{"), "lang", F.lit("}}: {examples} / {unknown} {objects}"))
    fields = {"domain_name": F.col("source"), "examples": F.col("text"), "objects": F.col("doc_id").cast("string")}
    return fx.table(spark, sf_dir, "documents").select("doc_id", P.render_each(template, fields).alias("prompt"))


def cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    capped = P.cap_per_category(_grid(spark, sf_dir, P.TARGET_PER_CATEGORY))
    return capped.select("category", F.col("ordinal").cast("long").alias("ordinal"), "domain", "prompt")


def remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.remaining_work(fx.document_plan(spark, sf_dir), fx.done(spark, sf_dir), "doc_id")


def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = fx.document_plan(spark, sf_dir)
    left = P.remaining_work(plan, fx.done(spark, sf_dir), "doc_id")
    results = fx.done(spark, sf_dir).join(plan, "doc_id")
    return P.plan_status(plan, results, left, target=20)


def one(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompt = F.concat(F.lit("Please GENERATE \n"), "n_chars", F.lit(" items; regenerate 3. "), "text")
    return fx.table(spark, sf_dir, "documents").select("doc_id", P.force_one(prompt).alias("prompt"))


def fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = F.when(F.col("doc_id") % 2 == 0, "more ").otherwise("")
    cover = F.when(F.col("doc_id") % 3 == 0, "Cover these 10 topics: ").otherwise("Topic: ")
    prompt = F.concat(F.lit("Generate 10 "), more, F.lit("training examples. "), cover, "text")
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", prompt.alias("prompt"))
    return P.with_fallback(docs).select("doc_id", "fallback_prompt", "changed")


def judge_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    ex = fx.examples(spark, sf_dir)
    return ex.select("doc_id", P.judge_prompt(TEMPLATE, F.col("output"), F.col("output"), 800, 3000).alias("prompt"))


def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompt = F.concat(F.lit("\n "), "text", F.lit("\t\n"))
    messages = P.envelope("You are strict.", prompt, suffix=P.FORMAT_REMINDER, strip_prompt=True)
    return fx.table(spark, sf_dir, "documents").select("doc_id", messages.alias("m")).select(
        "doc_id",
        F.size("m").cast("long").alias("n"),
        F.col("m")[0]["role"].alias("first_role"), F.col("m")[0]["content"].alias("first_content"),
        F.col("m")[1]["role"].alias("second_role"), F.col("m")[1]["content"].alias("second_content"),
    )


def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.progress(fx.document_plan(spark, sf_dir), fx.done(spark, sf_dir), "doc_id")


def model_call(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only what is left reaches the function; here it echoes."""
    left = P.remaining_work(fx.document_plan(spark, sf_dir), fx.done(spark, sf_dir), "doc_id")
    return infer(left, lambda prompts: "echo " + prompts, "doc_id")


QUERIES = {
    "p1_grid": grid,
    "p2_render": render,
    "p3_cap": cap,
    "p4_remaining": remaining,
    "p5_status": status,
    "p6_one": one,
    "p7_fallback": fallback,
    "p8_judge_prompt": judge_prompt,
    "p9_envelope": envelope,
    "r7_progress": progress,
    "u1_infer": model_call,
}

_PLAN = "plan AS (SELECT doc_id, doc_id AS ordinal, source AS category, lang AS domain, text AS prompt FROM documents)"
_REMINDER = """chr(10) || chr(10) || 'Respond using EXACTLY this format — no prose before or after:' || chr(10)
                 || '=== INSTRUCTION ===' || chr(10) || '<one sentence>' || chr(10) || '=== HTML ===' || chr(10) || '<html>' || chr(10)
                 || '=== JS ===' || chr(10) || '<js>' || chr(10) || '=== CSS ===' || chr(10) || '<css or NONE>'"""

ORACLES = {
    "p1_grid": f"WITH {GRID} SELECT category, max_tokens, ordinal, prompt, domain FROM grid",
    "p2_render": """
        SELECT doc_id, 'For ' || source || ' {' || lang || '}: ' || text || ' / {unknown} ' || doc_id AS prompt
        FROM documents""",
    "p3_cap": f"WITH {GRID} SELECT category, ordinal, domain, prompt FROM grid WHERE ordinal < 40",
    "p4_remaining": f"WITH {_PLAN} SELECT * FROM plan WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "p5_status": f"""WITH {_PLAN}
        SELECT category, count(l.doc_id) AS done, count(*) - count(l.doc_id) AS remaining,
               count(l.doc_id) >= 20 AS complete
        FROM plan LEFT JOIN labels l USING (doc_id) GROUP BY category""",
    "p6_one": """
        SELECT doc_id, 'Please Generate 1 items; regenerate 3. ' || text || chr(10) || chr(10)
          || 'IMPORTANT: Output EXACTLY 1 example (JSON array with ONE object). 100% complete, compilable, no truncation.' AS prompt
        FROM documents""",
    "p7_fallback": """
        SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'Generate 10 more training examples. ' ELSE 'Generate 5 training examples. ' END
          || CASE WHEN doc_id % 3 = 0 THEN 'Cover 5 of these topics: ' ELSE 'Topic: ' END || text AS fallback_prompt,
          doc_id % 2 <> 0 OR doc_id % 3 = 0 AS changed
        FROM documents""",
    "p8_judge_prompt": """
        SELECT doc_id, 'Rate this.' || chr(10) || left(text, 800) || chr(10) || '---' || chr(10) || left(text, 3000)
          || chr(10) || 'Answer as {json}.' AS prompt
        FROM documents""",
    "p9_envelope": f"""
        SELECT doc_id, 2::BIGINT AS n, 'system' AS first_role, 'You are strict.' AS first_content,
               'user' AS second_role, text || {_REMINDER} AS second_content
        FROM documents""",
    "r7_progress": """
        SELECT count(*) AS total, count(*) - count(l.doc_id) AS to_do, count(l.doc_id) AS done
        FROM documents LEFT JOIN labels l USING (doc_id)""",
    "u1_infer": """
        SELECT doc_id, 'echo ' || text AS raw FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
}
