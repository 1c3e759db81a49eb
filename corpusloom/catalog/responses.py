"""Raw responses to records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import fixtures as fx
from corpusloom.catalog.sql import SECTIONS
from corpusloom.functions.text import strip
from corpusloom.operators import responses as R
from corpusloom.operators import sections as S
from corpusloom.plans import generation_flow


def reasoning(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit("\n<think>a\nb"), "text", F.lit("</think>\n\n"), "text", F.lit("<think></think> <think>open"))
    return fx.texts(spark, sf_dir).select("doc_id", R.strip_reasoning(raw).alias("clean"))


def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.batch_records(fx.json_responses(spark, sf_dir), "call_id")


def record_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole outputs and such cut around the limit; input missing, null or given; an extra key."""
    d = F.col("doc_id")
    docs = fx.texts(spark, sf_dir).select("doc_id", "lang", F.explode(F.array("text", F.left("text", (190 + d % 20).cast("int")))).alias("text"))
    output = F.col("text")
    extra = F.struct(F.lit("i").alias("instruction"), output.alias("output"), F.lit("kept").alias("extra"))
    given = F.struct(F.lit("i").alias("instruction"), F.col("lang").alias("input"), output.alias("output"))
    raw = (
        F.when(d % 3 == 0, F.to_json(F.array(extra)))
        .when(d % 3 == 1, F.replace(F.to_json(F.array(given)), F.concat(F.lit('"input":"'), "lang", F.lit('"')), F.lit('"input":null')))
        .otherwise(F.to_json(F.array(given)))
    )
    parsed = R.batch_attempts(docs.select("doc_id", raw.alias("raw")))
    rows = R.explode_records(parsed, "doc_id")
    tagged = R.open_record(F.col("record"), category=F.lit("C-1"))
    return rows.select(
        "doc_id", "input", "output",
        F.get_json_object(tagged, "$.extra").alias("extra"), F.get_json_object(tagged, "$.category").alias("category"),
    )


def fences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fences of every language around and inside the text, or none at all."""
    case = F.col("doc_id") % 6
    language = F.element_at(F.array(*[F.lit(x) for x in S.FENCE_LANGUAGES]), (case + 1).cast("int"))
    fenced = F.concat(F.lit("```"), language, F.lit("\n"), "text", F.lit("\n```js\nx\n```"), F.lit("\n```\n```\n"))
    body = F.when(case == 5, F.col("text")).otherwise(strip(F.when(case < 5, fenced)))
    return S.strip_fences(fx.texts(spark, sf_dir).select("doc_id", body.alias("body")), "body")


def normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list, a lone object, a blank output, no JSON, or a null output, by doc_id % 5."""
    docs = fx.texts(spark, sf_dir)
    case = F.col("doc_id") % 5
    one = F.struct(F.col("source").alias("instruction"), F.lit("kept").alias("input"), F.col("text").alias("output"))
    blank = F.struct(F.lit("b").alias("instruction"), F.lit("").alias("input"), F.lit(" \n").alias("output"))
    raw = (
        F.when(case == 0, F.concat(F.lit("```json\n"), F.to_json(F.array(one, blank)), F.lit("\n```")))
        .when(case == 1, F.concat(F.lit("```\n"), F.to_json(one), F.lit("\n```\n")))
        .when(case == 2, F.to_json(F.array(blank)))
        .when(case == 3, F.concat(F.to_json(one), F.lit(" done")))
        .otherwise(F.concat(F.lit('[{"instruction":"n","output":null},'), F.to_json(one), F.lit("]")))
    )
    call = F.concat(F.when(F.col("doc_id") % 2 == 0, "domain_").otherwise("gen"), "source", F.lit("-"), "doc_id")
    tries = docs.select(call.alias("call_id"), F.lit(1).alias("attempt"), raw.alias("raw"))
    return generation_flow.object_results(tries)


def escapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.replace(F.replace(F.col("text"), F.lit("e"), F.lit("\\s")), F.lit("a"), F.lit("\\\\"))
    return fx.texts(spark, sf_dir).select("doc_id", R.repair_escapes(text).alias("repaired"))


def sections_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.section_records(fx.section_responses(spark, sf_dir), "page_id", mode="strict")
    return rows.select("page_id", "instruction", "name", "output")


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = S.split_sections(fx.section_responses(spark, sf_dir))
    return parts.select("page_id", "instruction", "html", "js", "css")


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.section_records(fx.section_responses(spark, sf_dir), "page_id").select("page_id", "name", "file")


def assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.section_records(fx.section_responses(spark, sf_dir), "page_id").select("page_id", "output")


def gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole pages and such cut to lengths around the limit."""
    short = F.left("html", (F.col("page_id") * 37 % 200).cast("int") + 1)
    cut = fx.texts(spark, sf_dir, "pages").withColumn("html", F.explode(F.array("html", short)))
    rows = S.section_records(fx.as_section_responses(cut), "page_id")
    return rows.where(S.long_enough(F.col("output"))).select("page_id", F.length("output").cast("long").alias("n"))


def first_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    tries = R.batch_attempts(fx.json_attempts(spark, sf_dir))
    order = R.attempt_order(F.col("stage"), F.col("attempt"))
    tries = tries.withColumn("won", F.struct((F.col("stage") * 10 + F.col("attempt")).alias("position"), F.size("records").alias("n")))
    won = R.first_acceptable(tries, ["call_id"], order, "won", F.size("records") > 0)
    return won.select("call_id", F.col("won.position").cast("long").alias("position"), F.col("won.n").cast("long").alias("n"))


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; wrong types, missing keys and plain text by doc_id % 6."""
    docs = fx.texts(spark, sf_dir)
    case = F.col("doc_id") % 6
    good = fx.judge_raw(F.col("doc_id"), F.col("n_chars"))
    raw = (
        F.when(case == 1, F.replace(good, F.lit('"alignment": '), F.lit('"alignment": "x", "y": ')))
        .when(case == 2, F.replace(good, F.lit('"reason"'), F.lit('"why"')))
        .when(case == 3, F.col("text"))
        .when(case == 4, F.replace(good, F.lit('"code_quality": '), F.lit('"code_quality": 0.5, "z": ')))
        .otherwise(good)
    )
    parsed = R.verdict_attempts(docs.select("doc_id", raw.alias("raw")))
    return parsed.select("doc_id", F.inline(F.when(F.col("verdict").isNotNull(), F.array("verdict"))))


QUERIES = {
    "x1_think": reasoning,
    "x2_json_records": json_records,
    "x3_normalise": normalise,
    "x5_record_gate": record_gate,
    "x4_escape": escapes,
    "x6_sections_strict": sections_strict,
    "x7_sections": sections,
    "x8_fences": fences,
    "x9_names": names,
    "x10_assemble": assembled,
    "x11_gate": gate,
    "x12_first_ok": first_ok,
    "x13_verdicts": verdicts,
}

ORACLES = {
    "x1_think": "SELECT doc_id, text || ' <think>open' AS clean FROM documents",
    "x2_json_records": """
        SELECT 'MIG-' || doc_id AS call_id, 0::BIGINT AS pos, split_part(text, chr(10), 1) AS instruction, '' AS input,
               text AS output
        FROM documents WHERE n_chars > 200""",
    "x3_normalise": """
        SELECT CASE WHEN doc_id % 2 = 0 THEN 'domain_' ELSE 'gen' END || source || '-' || doc_id AS call_id,
               CASE WHEN doc_id % 5 = 4 THEN 1 ELSE 0 END::BIGINT AS pos, source AS instruction, '' AS input,
               text AS output,
               CASE WHEN doc_id % 2 = 0 THEN 'domain_' ELSE 'gen' END || source AS category,
               CASE WHEN doc_id % 2 = 0 THEN 'domain' ELSE 'generic' END AS type
        FROM documents WHERE doc_id % 5 IN (0, 1, 4) AND trim(text) <> ''""",
    # every backslash put in is followed by s, a backslash or a text character
    "x4_escape": r"""
        SELECT doc_id, regexp_replace(replace(replace(text, 'e', '\s'), 'a', '\\'),
                 '\\([^"\\/bfnrtu0-9]|\z)', '\\\\\1', 'g') AS repaired
        FROM documents""",
    "x5_record_gate": """
        SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '' WHEN 2 THEN lang END AS input, text AS output,
               CASE WHEN doc_id % 3 = 0 THEN 'kept' END AS extra, 'C-1' AS category
        FROM (SELECT doc_id, lang, unnest([text, left(text, 190 + doc_id % 20)]) AS text FROM documents) WHERE length(text) > 200""",
    "x8_fences": """
        SELECT doc_id, CASE WHEN doc_id % 6 = 5 THEN text ELSE text || chr(10) || 'x' END AS body FROM documents""",
    "x6_sections_strict": f"WITH {SECTIONS} SELECT page_id, instruction, strict_name AS name, strict_output AS output FROM built WHERE page_id % 3 <> 2",
    "x7_sections": f"WITH {SECTIONS} SELECT page_id, instruction, html, js, css FROM sec",
    "x9_names": f"WITH {SECTIONS} SELECT page_id, name, file FROM built",
    "x10_assemble": f"WITH {SECTIONS} SELECT page_id, output FROM built",
    "x11_gate": f"""WITH {SECTIONS}
        SELECT page_id, length(output) - length(html) + length(cut) AS n
        FROM (SELECT *, rtrim(unnest([html, left(html, page_id * 37 % 200 + 1)])) AS cut FROM built)
        WHERE length(output) - length(html) + length(cut) > 200""",
    "x12_first_ok": """
        SELECT 'MIG-' || doc_id AS call_id, ((doc_id % 7) // 3) * 10 + (doc_id % 7) % 3 + 1 AS position, 1::BIGINT AS n
        FROM documents WHERE doc_id % 7 < 6 AND n_chars > 200""",
    "x13_verdicts": """
        SELECT doc_id, (2 + (doc_id * 7 + n_chars) % 4)::DOUBLE AS completeness,
               (2 + (doc_id * 3 + n_chars * 5) % 4)::DOUBLE AS alignment,
               (2 + (doc_id * 11 + n_chars * 3) % 4)::DOUBLE AS best_practices,
               CASE WHEN doc_id % 6 = 4 THEN 0.5 ELSE 2 + (doc_id + n_chars * 7) % 4 END::DOUBLE AS code_quality,
               'accept' AS judge_verdict, 'fits {well}' AS reason
        FROM documents WHERE doc_id % 6 IN (0, 4, 5)""",
}
