"""Work tables derived from the given parquet tables, one row in for one row out.

The formulas use integer arithmetic and plain text only, so the SQL side of
each check can state the expected result from the base columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.judging import with_content_key
from corpusloom.sources.jsonl import ORIGIN

FENCE = "```"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """A table of texts. One with fewer splits than there are cores, as the small test tables are, is dealt out."""
    rows = table(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


def first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def as_examples(documents: DataFrame) -> DataFrame:
    return documents.select(
        "doc_id",
        first_line(F.col("text")).alias("instruction"),
        F.lit("").alias("input"),
        F.col("text").alias("output"),
        F.col("source").alias("category"),
        F.col("lang").alias("type"),
        F.concat("source", F.lit(".jsonl")).alias(ORIGIN),
        "n_chars",
    )


def examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_examples(table(spark, sf_dir, "documents"))


def scores(doc: Column, n: Column) -> dict[str, Column]:
    return {
        "completeness": 2 + (doc * 7 + n) % 4,
        "alignment": 2 + (doc * 3 + n * 5) % 4,
        "best_practices": 2 + (doc * 11 + n * 3) % 4,
        "code_quality": 2 + (doc + n * 7) % 4,
    }


def with_scores(df: DataFrame) -> DataFrame:
    return df.withColumns(scores(F.col("doc_id"), F.col("n_chars")))


def judge_raw(doc: Column, n: Column) -> Column:
    """A judge response with prose, fences and braces inside a text."""
    parts = [F.lit(f"Here it is.\n{FENCE}json\n" + "{")]
    for name, score in scores(doc, n).items():
        parts += [F.lit(f'"{name}": '), score.cast("string"), F.lit(", ")]
    parts.append(F.lit('"verdict": "accept", "reason": "fits {well}"}\n' + FENCE))
    return F.concat(*parts)


def as_judge_responses(documents: DataFrame) -> DataFrame:
    """Attempts per distinct content, made from its lowest doc_id.

    Every 17th never succeeds within the limit (its fifth attempt would); a
    third fails once.
    """
    rep = (
        with_content_key(as_examples(documents))
        .groupBy("content_key")
        .agg(F.min("doc_id").alias("doc_id"), F.min("n_chars").alias("n_chars"))
    )
    valid_at = F.when(F.col("doc_id") % 17 == 0, 5).when(F.col("doc_id") % 3 == 0, 2).otherwise(1)
    rows = rep.withColumn("valid_at", valid_at).select("*", F.explode(F.sequence(F.lit(1), "valid_at")).alias("attempt"))
    raw = F.when(F.col("attempt") == F.col("valid_at"), judge_raw(F.col("doc_id"), F.col("n_chars"))).otherwise(
        '{"completeness": 5, "alignment": "5"'
    )
    return rows.select("content_key", F.col("attempt").cast("long").alias("attempt"), raw.alias("raw"))


def judge_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_judge_responses(table(spark, sf_dir, "documents"))


def as_json_responses(documents: DataFrame) -> DataFrame:
    """Reasoning, a fence and a list of two records, the second one cut short."""
    instruction = first_line(F.col("text")).alias("instruction")
    records = F.array(
        F.struct(instruction, F.col("text").alias("output")),
        F.struct(instruction, F.left("text", F.lit(50)).alias("output")),
    )
    raw = F.concat(F.lit(f"<think>plan [x]</think>\n{FENCE}json\n"), F.to_json(records), F.lit(f"\n{FENCE}\n"))
    return documents.select("doc_id", "n_chars", F.concat(F.lit("MIG-"), "doc_id").alias("call_id"), raw.alias("raw"))


def json_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_json_responses(texts(spark, sf_dir))


def json_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_attempts(json_responses(spark, sf_dir))


def as_attempts(responses: DataFrame) -> DataFrame:
    """Six attempts in two stages; the text is cut off until attempt doc_id % 7 + 1."""
    rows = responses.select("*", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("k"))
    raw = F.when(F.col("k") < F.col("doc_id") % 7, F.left("raw", F.length("raw") - 20)).otherwise(F.col("raw"))
    return rows.select(
        "call_id",
        F.floor(F.col("k") / 3).alias("stage"),
        (F.col("k") % 3 + 1).cast("long").alias("attempt"),
        raw.alias("raw"),
    )


def section_js(page: Column) -> Column:
    """An exported class, every fifth a test file, every seventh neither."""
    return (
        F.when(page % 7 == 0, F.lit("const a = 1;"))
        .when(page % 5 == 0, F.concat(F.lit("describe('c-page-card-"), page, F.lit("x', () => { it('a', f); });")))
        .otherwise(F.concat(F.lit("export default class Page"), page, F.lit(" {}")))
    )


def as_section_responses(pages: DataFrame) -> DataFrame:
    """page_id % 3: CSS says none, holds a rule, or the marker is missing."""
    page = F.col("page_id")
    css = F.when(page % 3 == 0, "\n=== CSS ===\nNone\n").when(
        page % 3 == 1, f"\n=== CSS ===\n{FENCE}css\n:host {{}}\n{FENCE}\n"
    ).otherwise("")
    raw = F.concat(
        F.lit("<think>=== HTML === first</think>\n\n=== INSTRUCTION ===\n"), "url",
        F.lit(f"\n\n=== HTML ===\n{FENCE}html\n"), "html",
        F.lit(f"\n{FENCE}\n\n=== JS ===\n{FENCE}javascript\n"), section_js(page), F.lit(f"\n{FENCE}\n"), css,
    )
    return pages.select("page_id", "url", raw.alias("raw"))


def section_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_section_responses(texts(spark, sf_dir, "pages"))


def as_components(documents: DataFrame) -> DataFrame:
    """Component text with one case of each repair rule by doc_id % 4."""
    case = F.col("doc_id") % 4
    body = F.concat(
        F.lit("class A {\n    @track name = 'x';\n    @track items = [];\n    isLoading = false;\n"),
        F.when(case == 1, "    get isLoading() { return true; }\n")
        .when(case == 2, "<!-- a.html -->\n<!-- b-c.html -->\n")
        .when(case == 3, f"/* a.css */\n{FENCE}css\n:host {{}}\n{FENCE}\n")
        .otherwise(""),
        F.lit("}\n"),
        "text",
    )
    return documents.select("doc_id", first_line(F.col("text")).alias("instruction"), body.alias("output"))


def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_components(texts(spark, sf_dir))


def plan_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One category per source; its variations are the event types."""
    # as many as there are types
    variations = table(spark, sf_dir, "events").agg(F.sort_array(F.collect_set("event_type"))).scalar()
    generic = F.transform(
        F.sequence(F.lit(0), F.lit(7)), lambda k: F.concat(F.lit("Describe "), F.col("category"), F.lit(" part "), k)
    )
    return (
        table(spark, sf_dir, "documents").select(F.col("source").alias("category")).distinct()
        .select(
            "category",
            F.lit(7000).cast("long").alias("max_tokens"),
            generic.alias("generic_prompts"),
            F.lit("Write on {examples} for a {domain_name} {context} with {objects}. {variation} {{ok}}").alias("domain_template"),
            variations.alias("variations"),
        )
    )


def plan_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("position"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("Obj_"), "n_regionkey", F.lit("__c")).alias("objects"),
        F.concat(F.lit("firm {variation} "), "n_nationkey").alias("context"),
        F.concat(F.lit("case "), "n_nationkey").alias("examples"),
    )


def document_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plan row per document: its prompt is the whole text."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("doc_id").alias("ordinal"),
        F.col("source").alias("category"),
        F.col("lang").alias("domain"),
        F.col("text").alias("prompt"),
    )


def done(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id")


def lint_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with one policy case each, by doc_id % 9."""
    snippets = (
        "// TODO later\n",
        "public class Foo {}\n",
        "public with sharing class Foo {}\n",
        "x = [SELECT Id FROM Account];\n",
        "x = [SELECT Id FROM Account WITH SECURITY_ENFORCED];\n",
        "id = '001000000000001';\n",
        "System.assert( true );\n",
        "<template if:true={a}></template>\n",
    )
    case = F.col("doc_id") % 9
    snippet = F.lit("<p style='color:red'></p>\n")
    for k, text in enumerate(snippets):
        snippet = F.when(case == k, text).otherwise(snippet)
    return texts(spark, sf_dir).select("doc_id", F.concat(snippet, "text").alias("output"))
