"""Verdicts and the reports over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import fixtures as fx
from corpusloom.catalog.sql import JUDGED
from corpusloom.operators import judging, reports
from corpusloom.operators.responses import OBJECT_ATTEMPTS
from corpusloom.plans import judging_flow
from corpusloom.session import work_dir


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judging_flow.judged_examples(
        fx.examples(spark, sf_dir), fx.judge_responses(spark, sf_dir), max_attempts=OBJECT_ATTEMPTS
    )


def enforced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half scores, so averages end on eighths and rounding meets ties."""
    docs = fx.table(spark, sf_dir, "documents")
    marks = {s: (F.floor(6 + (F.col("doc_id") * k + F.col("n_chars")) % 5) / 2) for k, s in enumerate(judging.SCORES, 1)}
    return judging.enforce(docs.select("doc_id", *[c.cast("double").alias(s) for s, c in marks.items()])).select(
        "doc_id", "avg_score", "verdict"
    )


def defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts by document, missing for every 17th."""
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    some = judging.enforce(fx.with_scores(docs.where("doc_id % 17 <> 0"))).withColumn("reason", F.lit("ok")).drop("n_chars")
    return judging.with_default(docs.join(some, "doc_id", "left")).drop("n_chars")


def attached(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark, sf_dir).select("doc_id", "content_key", *judging.VERDICT_COLUMNS)


def resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents still to judge when the labelled documents have their verdicts."""
    former = judged(spark, sf_dir).join(fx.done(spark, sf_dir), "doc_id", "left_semi")
    former = former.select("content_key", "avg_score").distinct()
    work = judging.judge_work(judging.with_content_key(fx.examples(spark, sf_dir)), former)
    return work.select("instruction", "output")


def split(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.when(F.col("verdict") == judging.ACCEPT, "clean").otherwise("rejected")
    return judged(spark, sf_dir).select("doc_id", part.alias("part"))


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.qc_summary(judged(spark, sf_dir))


def by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judged(spark, sf_dir)
    hidden = F.when(F.col("doc_id") % 10 != 0, F.col("category"))
    return reports.pass_rate_by_category(rows.withColumn("category", hidden))


def worst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.worst_categories(reports.pass_rate_by_category(judged(spark, sf_dir)))


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole judging job with all its sinks; the report table is the result."""
    done = judging_flow.judge_corpus(
        fx.examples(spark, sf_dir), fx.judge_responses(spark, sf_dir), work_dir(spark, "corpus"), "judge",
        max_attempts=OBJECT_ATTEMPTS,
    )
    return done.by_category


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.examples(spark, sf_dir).withColumn("filename", F.concat("type", F.lit(".jsonl")))


def short(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.shortfall(fx.examples(spark, sf_dir), target=50)


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in plan order, the plan naming each file once and one that is absent."""
    rows = _records(spark, sf_dir)
    plan = rows.groupBy("filename").agg(F.min("doc_id").alias("ordinal"))
    absent = plan.select(F.concat(F.lit("no-"), "filename").alias("filename"), (F.col("ordinal") + 1000000).alias("ordinal"))
    return reports.planned_file_counts(plan.unionByName(absent), rows)


def all_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.file_counts(_records(spark, sf_dir))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some texts end with breaks, some are empty."""
    out = F.when(F.col("doc_id") % 4 == 0, F.concat("text", F.lit("\r\n\n"))).when(F.col("doc_id") % 4 == 1, "").otherwise(F.col("text"))
    return reports.output_lines(fx.table(spark, sf_dir, "documents").select("doc_id", out.alias("output"))).drop("output")


QUERIES = {
    "j2_verdict": enforced,
    "j3_default": defaults,
    "j4_attach": attached,
    "j5_resume": resumed,
    "j6_split": split,
    "r1_summary": summary,
    "r2_by_category": by_category,
    "r3_worst": worst,
    "r4_shortfall": short,
    "r5_files": files,
    "r5_all_files": all_files,
    "r6_lines": lines,
    "e2_corpus": corpus,
}

_RATE = """count(*) FILTER (verdict = 'accept') AS accept, count(*) FILTER (verdict = 'reject') AS reject,
               round_even(count(*) FILTER (verdict = 'accept') / greatest(count(*), 1)::DOUBLE * 100, 1) AS pass_rate"""

ORACLES = {
    "j2_verdict": """
        WITH m AS (
          SELECT doc_id, (6 + (doc_id + n_chars) % 5) / 2.0::DOUBLE AS a, (6 + (doc_id * 2 + n_chars) % 5) / 2.0::DOUBLE AS b,
                 (6 + (doc_id * 3 + n_chars) % 5) / 2.0::DOUBLE AS c, (6 + (doc_id * 4 + n_chars) % 5) / 2.0::DOUBLE AS d
          FROM documents)
        SELECT doc_id, round_even((a + b + c + d) / 4, 2) AS avg_score,
               CASE WHEN least(a, b, c, d) >= 3 AND round_even((a + b + c + d) / 4, 2) >= 3.5 THEN 'accept' ELSE 'reject' END AS verdict
        FROM m""",
    "j3_default": """
        WITH m AS (
          SELECT doc_id, doc_id % 17 <> 0 AS has, 2 + (doc_id * 7 + n_chars) % 4 AS a, 2 + (doc_id * 3 + n_chars * 5) % 4 AS b,
                 2 + (doc_id * 11 + n_chars * 3) % 4 AS c, 2 + (doc_id + n_chars * 7) % 4 AS d
          FROM documents)
        SELECT doc_id, CASE WHEN has THEN a ELSE 0 END::DOUBLE AS completeness, CASE WHEN has THEN b ELSE 0 END::DOUBLE AS alignment,
               CASE WHEN has THEN c ELSE 0 END::DOUBLE AS best_practices, CASE WHEN has THEN d ELSE 0 END::DOUBLE AS code_quality,
               CASE WHEN has THEN (a + b + c + d) / 4.0 ELSE 0 END::DOUBLE AS avg_score,
               CASE WHEN has AND least(a, b, c, d) >= 3 AND a + b + c + d >= 14 THEN 'accept' ELSE 'reject' END AS verdict,
               CASE WHEN has THEN 'ok' ELSE 'Judge error after 4 attempts' END AS reason
        FROM m""",
    "j4_attach": f"""WITH {JUDGED}
        SELECT doc_id, sha256(length(instruction) || ':' || instruction || output) AS content_key, completeness, alignment, best_practices,
               code_quality, avg_score, verdict, reason FROM judged""",
    "j5_resume": f"""WITH {JUDGED}
        SELECT DISTINCT instruction, output FROM judged
        WHERE output NOT IN (SELECT output FROM judged WHERE avg_score > 0 AND doc_id IN (SELECT doc_id FROM labels))""",
    "j6_split": f"WITH {JUDGED} SELECT doc_id, CASE verdict WHEN 'accept' THEN 'clean' ELSE 'rejected' END AS part FROM judged",
    "r1_summary": f"""WITH {JUDGED}
        SELECT count(*) AS total, count(*) FILTER (verdict = 'accept') AS accepted, count(*) FILTER (verdict = 'reject') AS rejected,
               round_even(count(*) FILTER (verdict = 'accept') / greatest(count(*), 1)::DOUBLE * 100, 1) AS acceptance_rate,
               round_even(sum(avg_score) FILTER (verdict = 'accept') / count(*) FILTER (verdict = 'accept'), 2) AS avg_score_accepted,
               round_even(sum(avg_score) FILTER (verdict = 'reject') / count(*) FILTER (verdict = 'reject'), 2) AS avg_score_rejected
        FROM judged""",
    "r2_by_category": f"""WITH {JUDGED}
        SELECT CASE WHEN doc_id % 10 <> 0 THEN category ELSE 'unknown' END AS category, {_RATE} FROM judged GROUP BY 1""",
    "r3_worst": f"WITH {JUDGED} SELECT category, {_RATE} FROM judged GROUP BY 1 ORDER BY pass_rate, category LIMIT 5",
    "r4_shortfall": "SELECT source AS category, count(*) AS n, greatest(50 - count(*), 0) AS short FROM documents GROUP BY 1",
    "r5_files": """
        SELECT min(doc_id) AS ordinal, lang || '.jsonl' AS filename, count(*) AS n, 0::BIGINT AS is_total FROM documents GROUP BY 2
        UNION ALL SELECT NULL, NULL, count(*), 1 FROM documents""",
    "r5_all_files": """
        SELECT lang || '.jsonl' AS filename, count(*) AS n, 0::BIGINT AS is_total FROM documents GROUP BY 1
        UNION ALL SELECT NULL, count(*), 1 FROM documents""",
    "r6_lines": """
        SELECT doc_id, CASE doc_id % 4 WHEN 1 THEN 0
                 ELSE len(string_split(text, chr(10))) - (CASE WHEN right(text, 1) = chr(10) THEN 1 ELSE 0 END)
                      + CASE WHEN doc_id % 4 = 0 THEN 1 + (CASE WHEN right(text, 1) = chr(10) THEN 1 ELSE 0 END) ELSE 0 END
               END::BIGINT AS n_lines
        FROM documents""",
    "e2_corpus": f"WITH {JUDGED} SELECT category, {_RATE} FROM judged GROUP BY 1",
}
