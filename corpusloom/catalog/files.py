"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import fixtures as fx
from corpusloom.catalog.sql import EXAMPLES, JUDGED
from corpusloom.operators import judging, reports
from corpusloom.operators.responses import OBJECT_ATTEMPTS
from corpusloom.plans import judging_flow
from corpusloom.session import stage, work_dir
from corpusloom.sources import calls, jsonl

SCHEMA = jsonl.GENERATED


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    ex = judging.with_content_key(fx.examples(spark, sf_dir))
    verdicts = judging.verdicts_from_responses(fx.judge_responses(spark, sf_dir), max_attempts=OBJECT_ATTEMPTS)
    return judging.attach(ex, verdicts)


def _examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.examples(spark, sf_dir).select(*SCHEMA.names, jsonl.ORIGIN)


def scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "scan")
    jsonl.write_by_origin(_examples(spark, sf_dir), path)
    rows = jsonl.scan_examples(spark, path, SCHEMA, glob="*.json")
    return rows.select("instruction", "input", "output", "category", "type", F.col(jsonl.ORIGIN).alias("source_file"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as JSON lines with an extra key and one that is null, by origin."""
    record = F.struct("instruction", "input", "output", "category", F.col("doc_id").alias("extra"), F.lit(None).cast("string").alias("none"))
    lines = F.to_json(record, {"ignoreNullFields": "false"})
    return fx.examples(spark, sf_dir).select(lines.alias("record"), jsonl.ORIGIN)


def scan_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "open")
    jsonl.write_records(_lines(spark, sf_dir), path, jsonl.ORIGIN)
    rows = jsonl.scan_records(spark, path, glob="*.txt")
    return rows.select(
        F.get_json_object("record", "$.extra").cast("long").alias("doc_id"), "instruction", "output", "category",
        F.contains("record", F.lit('"none":null')).alias("keeps_null"), F.col(jsonl.ORIGIN).alias("source_file"),
    )


def corpus_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan, judge and write records of open shape; all three sinks read back."""
    path, out = work_dir(spark, "open"), work_dir(spark, "open-corpus")
    jsonl.write_records(_lines(spark, sf_dir), path, jsonl.ORIGIN)
    records = jsonl.scan_records(spark, path, glob="*.txt")
    judging_flow.judge_records(records, fx.judge_responses(spark, sf_dir), out, "judge", max_attempts=OBJECT_ATTEMPTS)
    parts = [
        spark.read.text(f"{out}/{name}").select(F.lit(name).alias("part"), F.col("value").alias("record"))
        for name in ("clean", "final", "rejected")
    ]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.select(
        "part", F.get_json_object("record", "$.extra").cast("long").alias("doc_id"), F.get_json_object("record", "$.output").alias("output"),
        F.contains("record", F.lit('"none":null')).alias("keeps_null"),
        F.get_json_object("record", "$._qc.avg_score").cast("double").alias("avg_score"), F.get_json_object("record", "$._qc.reason").alias("reason"),
    )


def load_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A glob over the folders of a few origins; the others are never listed."""
    path = work_dir(spark, "load")
    jsonl.write_by_origin(_examples(spark, sf_dir), path)
    rows = jsonl.scan_examples(spark, f"{path}/{jsonl.ORIGIN}=*[02468].jsonl", SCHEMA, glob="*.json")
    return jsonl.public_columns(rows).select(*SCHEMA.names)


def scan_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.table(spark, sf_dir, "documents")
    example = F.struct(F.col("source").alias("instruction"), F.col("text").alias("output"))
    path = work_dir(spark, "strict-log")
    docs.select(F.concat(F.lit("p"), "doc_id").alias("prompt"), example.alias("example")).write.json(path)
    return jsonl.strict_log(spark, path, jsonl.strings("instruction", "output")).select("prompt", "example.*")


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report as written, read back as numbers."""
    path = work_dir(spark, "report")
    rows = stage(_judged(spark, sf_dir).select("category", "verdict", "avg_score"), work_dir(spark, "judged"))
    reports.report_json(reports.qc_summary(rows), reports.pass_rate_by_category(rows), "judge").write.text(path)
    schema = "judge string, total long, accepted long, rejected long, category string, accept long, reject long, pass_rate double"
    return spark.read.schema(schema).json(path)


def scan_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.table(spark, sf_dir, "documents")
    prompt = F.concat(F.lit("p"), "doc_id")
    example = F.struct(F.col("text").alias("output"), F.col("source").alias("category"))
    full = F.to_json(F.struct(prompt.alias("prompt"), example.alias("example")))
    case = F.col("doc_id") % 6
    line = (
        F.when(case == 0, F.left(full, F.length(full) - 1))
        .when(case == 1, F.concat(F.lit("["), full, F.lit("]")))
        .when(case == 2, F.to_json(F.struct(prompt.alias("prompt"))))
        .when(case == 3, F.to_json(F.struct(example.alias("example"))))
        .when(case == 4, F.lit("  "))
        .otherwise(full)
    )
    path = work_dir(spark, "log")
    docs.select(line.alias("value")).write.text(path)
    log = jsonl.tolerant_log(spark.read.text(path))
    return log.select(
        "prompt", "has_example",
        F.try_variant_get("example", "$.output", "string").alias("output"),
        F.try_variant_get("example", "$.category", "string").alias("category"),
    )


def roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "clean")
    jsonl.write_clean(_judged(spark, sf_dir).select(*SCHEMA.names, jsonl.ORIGIN, "content_key", *judging.VERDICT_COLUMNS), path)
    rows = jsonl.scan_examples(spark, path, SCHEMA, glob="*.json")
    return rows.groupBy(F.col(jsonl.ORIGIN).alias("source_file")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("output")).alias("chars")
    )


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "final")
    kept = judging.without_verdict(judging.accepted(_judged(spark, sf_dir)))
    jsonl.write_merged(kept.select("instruction", "input", "output", "category", "type", jsonl.ORIGIN), path)
    return spark.read.schema(SCHEMA).json(path)


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "rejected")
    jsonl.write_rejects(_judged(spark, sf_dir), path)
    qc = T.StructType(
        [T.StructField(s, T.DoubleType()) for s in judging.SCORES]
        + [T.StructField("avg_score", T.DoubleType()), T.StructField("verdict", T.StringType()), T.StructField("reason", T.StringType())]
    )
    schema = T.StructType([T.StructField("doc_id", T.LongType()), *SCHEMA.fields, T.StructField("_qc", qc)])
    return spark.read.schema(schema).json(path).select("doc_id", "category", "_qc.*")


def overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written once, rewritten for half of the calls, the second write run twice, with buckets that are split meanwhile."""
    path = work_dir(spark, "calls")
    rows = fx.examples(spark, sf_dir).select("doc_id", F.concat(F.lit("MIG-"), "doc_id").alias("call_id"), F.lit(1).alias("version"))
    calls.overwrite_calls(rows, path, bucket_rows=1_000)
    again = rows.where("doc_id % 2 = 0").withColumn("version", F.lit(2))
    calls.overwrite_calls(again, path, bucket_rows=1_000)
    calls.overwrite_calls(again, path, bucket_rows=700)
    stored = calls.read_calls(spark, path)
    return stored.groupBy("call_id").agg(F.count(F.lit(1)).alias("n"), F.max("version").cast("long").alias("version"))


def public(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jsonl.public_columns(fx.examples(spark, sf_dir).withColumn("_qc", F.lit("x")))


QUERIES = {
    "s1_scan": scan,
    "s2_scan_tolerant": scan_tolerant,
    "s3_scan_strict": scan_strict,
    "s4_roundtrip": roundtrip,
    "s5_merged": merged,
    "s6_rejects": rejects,
    "s7_overwrite": overwrite,
    "s8_report": report,
    "s9_public": public,
    "s10_load": load_one,
    "s1_open": scan_open,
    "e2_open": corpus_open,
}

ORACLES = {
    "s1_open": f"""WITH {EXAMPLES}
        SELECT doc_id, instruction, output, category, true AS keeps_null, source_file FROM ex""",
    "e2_open": f"""WITH {JUDGED}
        SELECT unnest(CASE verdict WHEN 'accept' THEN ['clean', 'final'] ELSE ['rejected'] END) AS part, doc_id, output, true AS keeps_null,
               CASE verdict WHEN 'accept' THEN NULL ELSE avg_score END AS avg_score,
               CASE verdict WHEN 'accept' THEN NULL ELSE reason END AS reason
        FROM judged""",
    "s1_scan": f"WITH {EXAMPLES} SELECT instruction, input, output, category, type, source_file FROM ex",
    "s2_scan_tolerant": """
        SELECT 'p' || doc_id AS prompt, doc_id % 6 = 5 AS has_example,
               CASE WHEN doc_id % 6 = 5 THEN text END AS output, CASE WHEN doc_id % 6 = 5 THEN source END AS category
        FROM documents WHERE doc_id % 6 IN (2, 5)""",
    "s3_scan_strict": "SELECT 'p' || doc_id AS prompt, source AS instruction, text AS output FROM documents",
    "s4_roundtrip": f"""WITH {JUDGED}
        SELECT source_file, count(*) AS n, sum(length(output))::BIGINT AS chars FROM judged
        WHERE verdict = 'accept' GROUP BY 1""",
    "s5_merged": f"WITH {JUDGED} SELECT instruction, input, output, category, type FROM judged WHERE verdict = 'accept'",
    "s6_rejects": f"""WITH {JUDGED}
        SELECT doc_id, category, completeness, alignment, best_practices, code_quality, avg_score, verdict, reason
        FROM judged WHERE verdict = 'reject'""",
    "s7_overwrite": """
        SELECT 'MIG-' || doc_id AS call_id, 1::BIGINT AS n, CASE WHEN doc_id % 2 = 0 THEN 2 ELSE 1 END::BIGINT AS version
        FROM documents""",
    "s8_report": f"""WITH {JUDGED}
        SELECT 'judge' AS judge, count(*) AS total, count(*) FILTER (verdict = 'accept') AS accepted,
               count(*) FILTER (verdict = 'reject') AS rejected, NULL AS category, NULL::BIGINT AS accept, NULL::BIGINT AS reject,
               NULL::DOUBLE AS pass_rate
        FROM judged
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, category, count(*) FILTER (verdict = 'accept'), count(*) FILTER (verdict = 'reject'),
               round_even(count(*) FILTER (verdict = 'accept') / count(*)::DOUBLE * 100, 1)
        FROM judged GROUP BY category""",
    "s10_load": f"""WITH {EXAMPLES}
        SELECT instruction, input, output, category, type FROM ex WHERE ascii(right(category, 1)) % 2 = 0""",
    "s9_public": f"WITH {EXAMPLES} SELECT doc_id, instruction, input, output, category, type, n_chars FROM ex",
}
