"""Generation end to end, from attempts to shaped records."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import fixtures as fx
from corpusloom.catalog.sql import GRID, SECTIONS
from corpusloom.operators import planning
from corpusloom.operators import responses as R
from corpusloom.plans import corpus_flow, generation_flow
from corpusloom.plans.calling import call_rounds
from corpusloom.session import stage, work_dir
from corpusloom.sources import jsonl


def sectioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plan, attempts, parse, repair, shape; page_id % 4 fails three times."""
    pages = fx.table(spark, sf_dir, "pages")
    plan = pages.select(
        F.concat(F.lit("prompt "), "page_id").alias("prompt"), F.concat(F.lit("Part "), F.col("page_id") % 10).alias("category"),
        F.lit("Web").alias("domain"),
    )
    tries = fx.section_responses(spark, sf_dir).select("*", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("attempt"))
    raw = F.when(F.col("attempt") <= F.col("page_id") % 4, F.replace("raw", F.lit("=== JS ==="), F.lit("=== J ==="))).otherwise(F.col("raw"))
    responses = tries.select(F.concat(F.lit("prompt "), "page_id").alias("prompt"), "attempt", raw.alias("raw"))
    return generation_flow.sectioned_results(plan, responses, max_attempts=R.SECTION_ATTEMPTS)


def strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two attempts per page; odd pages lose their CSS marker in the first one."""
    tries = fx.section_responses(spark, sf_dir).select("*", F.explode(F.sequence(F.lit(1), F.lit(2))).alias("attempt"))
    lost = (F.col("attempt") == 1) & (F.col("page_id") % 2 == 1)
    raw = F.when(lost, F.replace("raw", F.lit("=== CSS ==="), F.lit(""))).otherwise(F.col("raw"))
    responses = tries.select(F.concat(F.lit("prompt "), "page_id").alias("prompt"), "attempt", raw.alias("raw"))
    return generation_flow.strict_results(responses, max_attempts=R.SECTION_ATTEMPTS)


def batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six attempts in two stages to tagged records of the calls still to do."""
    calls = fx.json_attempts(spark, sf_dir)
    finished = fx.done(spark, sf_dir).select(F.concat(F.lit("MIG-"), "doc_id").alias("call_id"))
    todo = planning.remaining_work(calls, finished, "call_id")
    return generation_flow.batch_results(todo, "migration", max_attempts=R.BATCH_ATTEMPTS).drop("record")


def batched_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch records with an extra and a null key, tagged by call, to their sink and back."""
    docs = fx.table(spark, sf_dir, "documents")
    record = F.struct(
        fx.first_line(F.col("text")).alias("instruction"), F.col("text").alias("output"), F.col("lang").alias("extra"),
        F.lit(None).cast("string").alias("none"), F.lit("theirs").alias("category"),
    )
    raw = F.to_json(F.array(record), {"ignoreNullFields": "false"})
    calls = docs.select(F.concat(F.lit("MIG-"), "doc_id").alias("call_id"), F.lit(0).alias("stage"), F.lit(1).alias("attempt"), raw.alias("raw"))
    found = generation_flow.batch_results(calls, "migration")
    path = work_dir(spark, "batch-records")
    jsonl.write_records(found.select(R.open_record(F.col("record"), category=F.col("category"), type=F.col("type")).alias("record")), path)
    line = F.col("value")
    return spark.read.text(path).select(
        *[F.get_json_object(line, f"$.{k}").alias(k) for k in ("instruction", "output", "category", "type", "extra")],
        F.contains(line, F.lit('"none":null')).alias("keeps_null"),
    )


def _grid_corpus(spark: SparkSession, sf_dir: str) -> corpus_flow.SectionedCorpus:
    """The grid up to 60 prompts a category; every fifth prompt is in a log, of these every second without an example.

    Prompt k of a category fails k % 4 times, so every fourth never succeeds within the limit.
    """
    plan = planning.prompt_grid(fx.plan_categories(spark, sf_dir), fx.plan_domains(spark, sf_dir), "position")
    out, log = work_dir(spark, "grid-corpus"), work_dir(spark, "grid-log")
    prompt, k = F.col("prompt"), F.col("ordinal")
    example = F.struct(
        prompt.alias("prompt"), F.lit("kept").alias("completion"), F.lit("").alias("input"), F.lit("log").alias("source"),
        F.lit("lwc").alias("type"), "category", "domain",
    )
    full, bare = F.to_json(F.struct(prompt, example.alias("example"))), F.to_json(F.struct(prompt))
    plan.where(k % 5 == 0).select(F.when(k % 2 == 0, full).otherwise(bare).alias("value")).write.text(log)
    tries = plan.select("*", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("attempt"))
    raw = F.concat(
        F.lit("=== INSTRUCTION ===\n"), prompt, F.lit("\n=== HTML ===\n"), F.repeat(prompt, F.lit(6)),
        F.when(F.col("attempt") <= k % 4, "\n=== J ===\n").otherwise("\n=== JS ===\n"), F.lit("const a = 1;\n=== CSS ===\nNONE\n"),
    )
    responses = tries.select("prompt", "attempt", raw.alias("raw"))
    return corpus_flow.sectioned_corpus(plan, responses, out, jsonl.tolerant_log(spark.read.text(log)), target=60)


def grid_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grid_corpus(spark, sf_dir).final


def grid_shortfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = _grid_corpus(spark, sf_dir)
    return done.shortfall.join(done.status.select("category", "remaining"), "category")


def _call_corpus(spark: SparkSession, sf_dir: str) -> corpus_flow.CallCorpus:
    """Calls of even documents run first and alone; then all, with answers to everything.

    Answers are kept once; the six attempts of a call are made of its own as a round reads them.
    """
    out, answers = work_dir(spark, "call-corpus"), work_dir(spark, "call-answers")
    docs = fx.table(spark, sf_dir, "documents")
    plan = docs.select(
        F.concat(F.lit("MIG-"), "doc_id").alias("call_id"), F.col("doc_id").alias("ordinal"), F.concat(F.lit("out-"), F.col("doc_id") % 50, F.lit(".jsonl")).alias("filename")
    )
    family, responses = corpus_flow.batch_family("migration"), fx.as_attempts(stage(fx.json_responses(spark, sf_dir), answers))
    corpus_flow.call_corpus(plan.where("ordinal % 2 = 0"), responses, out, family)
    return corpus_flow.call_corpus(plan, responses, out, family)


def call_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _call_corpus(spark, sf_dir).records
    return rows.select("call_id", "pos", "instruction", "input", "output", "category", "type", "filename", F.get_json_object("record", "$.type").alias("record_type"))


def call_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per file; a file with many calls is counted once."""
    done = _call_corpus(spark, sf_dir)
    counts = done.files.where("is_total = 0").groupBy("filename").agg(F.max("n").alias("n"), F.min("ordinal").alias("ordinal"))
    left = done.open_calls.groupBy("filename").agg(F.count(F.lit(1)).alias("open"))
    return counts.join(left, "filename", "left").select("filename", "n", "ordinal", F.coalesce("open", F.lit(0).cast("long")).alias("open"))


def call_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects per call; the first answer is no JSON for every third, an empty list for every seventh."""
    out = work_dir(spark, "object-corpus")
    docs = fx.texts(spark, sf_dir)
    call = F.concat(F.when(F.col("doc_id") % 2 == 0, "domain_").otherwise("gen"), "source", F.lit("-"), "doc_id")
    plan = docs.select(call.alias("call_id"), F.col("doc_id").alias("ordinal"), F.concat("source", F.lit(".jsonl")).alias("filename"))
    good = F.to_json(F.struct(F.col("source").alias("instruction"), F.col("text").alias("output")))
    raw = F.when((F.col("doc_id") % 3 == 0) & (F.col("attempt") == 1), "sorry").when(F.col("doc_id") % 7 == 0, "[]").otherwise(good)
    tries = docs.select("*", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("attempt"))
    responses = tries.select(call.alias("call_id"), F.lit(0).alias("stage"), "attempt", raw.alias("raw"))
    done = corpus_flow.call_corpus(plan, responses, out, corpus_flow.object_family())
    return done.records.select("call_id", "pos", "instruction", "output", "category", "type", "filename")


def rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full prompt, then the fallback; prompts of odd length fail in full."""
    def model(prompts: pd.Series) -> pd.Series:
        answers = prompts.map(lambda p: json.dumps([{"instruction": p, "output": p * 4}]))
        return answers.where((prompts.str.len() % 2 == 0) | prompts.str.startswith("Generate 5"), "sorry")

    prompt = F.concat(F.lit("Generate 10 training examples. Cover these 10 topics: "), "text")
    plan = planning.with_fallback(fx.table(spark, sf_dir, "documents").select("doc_id", prompt.alias("prompt")))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("instruction", T.StringType()), T.StructField("output", T.StringType())])
    log = call_rounds(
        plan, model, lambda answers: R.batch_records(answers, "doc_id").select(*schema.names),
        work_dir(spark, "rounds"), schema, "doc_id", ("prompt", "fallback_prompt"),
    )
    return log.select("doc_id", F.col("batch_id").alias("round"), "instruction", F.length("output").cast("long").alias("n"))


def budgeted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages and a token limit per call, packed into tasks; the model tells what it was given."""
    def model(calls: pd.DataFrame) -> pd.Series:
        told = [f"{len(m)}:{m[-1]['role']}:{m[-1]['content'][:20]}:{n}" for m, n in zip(calls["messages"], calls["max_tokens"])]
        return pd.Series(told)

    docs = fx.table(spark, sf_dir, "documents")
    plan = docs.select("doc_id", planning.envelope("You write.", F.col("text")).alias("messages"), (100 + F.col("n_chars") % 50).alias("max_tokens"))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("raw", T.StringType())])
    log = call_rounds(
        plan, model, lambda answers: answers, work_dir(spark, "budget"), schema, "doc_id", ("messages",), slices=2,
        answer_tokens="max_tokens", budget=50_000, in_flight=64,
    )
    return log.select("doc_id", "raw")


QUERIES = {
    "e1_sectioned": sectioned, "e1_strict": strict, "e3_batched": batched, "e3_open": batched_open, "u1_rounds": rounds, "u1_budget": budgeted,
    "e1_corpus": grid_corpus, "e1_shortfall": grid_shortfall, "e3_corpus": call_records, "e3_files": call_files, "e3_objects": call_objects,
}

_GRID_RESULT = f"""WITH {GRID},
        capped AS (SELECT * FROM grid WHERE ordinal < 60),
        final AS (
          SELECT prompt, 'kept' AS completion, '' AS input, 'log' AS source, 'lwc' AS type, category, domain
          FROM grid WHERE ordinal % 10 = 0
          UNION ALL
          SELECT prompt, '<!-- myComponent.html -->' || chr(10) || repeat(prompt, 6) || chr(10) || chr(10) || '// myComponent.js' || chr(10) || 'const a = 1;',
                 '', 'synthetic_lwc_master/' || replace(replace(lower(category), ' ', '_'), '/', '_'), 'lwc', category, domain
          FROM capped WHERE ordinal % 5 <> 0 AND ordinal % 4 <> 3 AND length(prompt) * 6 + 60 > 200)"""

ORACLES = {
    "e1_corpus": f"{_GRID_RESULT} SELECT * FROM final",
    "e1_shortfall": f"""{_GRID_RESULT}
        SELECT category, n, greatest(60 - n, 0) AS short, planned - done AS remaining
        FROM (SELECT category, count(*) AS n FROM final GROUP BY 1)
        JOIN (SELECT category, count(*) AS planned, count(*) FILTER (ordinal % 5 = 0 OR prompt IN (SELECT prompt FROM final)) AS done
              FROM capped GROUP BY 1) USING (category)""",
    "e3_corpus": """
        SELECT 'MIG-' || doc_id AS call_id, 0::BIGINT AS pos, split_part(text, chr(10), 1) AS instruction, '' AS input, text AS output,
               'MIG-' || doc_id AS category, 'migration' AS type, 'out-' || doc_id % 50 || '.jsonl' AS filename, 'migration' AS record_type
        FROM documents WHERE doc_id % 7 < 6 AND n_chars > 200""",
    "e3_files": """
        SELECT 'out-' || doc_id % 50 || '.jsonl' AS filename, count(*) FILTER (doc_id % 7 < 6 AND n_chars > 200) AS n, min(doc_id) AS ordinal,
               count(*) FILTER (doc_id % 7 = 6 OR n_chars <= 200) AS open
        FROM documents GROUP BY 1""",
    "e3_objects": """
        SELECT CASE WHEN doc_id % 2 = 0 THEN 'domain_' ELSE 'gen' END || source || '-' || doc_id AS call_id, 0::BIGINT AS pos, source AS instruction,
               text AS output, CASE WHEN doc_id % 2 = 0 THEN 'domain_' ELSE 'gen' END || source AS category,
               CASE WHEN doc_id % 2 = 0 THEN 'domain' ELSE 'generic' END AS type, source || '.jsonl' AS filename
        FROM documents WHERE doc_id % 7 <> 0 AND trim(text) <> ''""",
    "e3_open": """
        SELECT split_part(text, chr(10), 1) AS instruction, text AS output, 'MIG-' || doc_id AS category, 'migration' AS type,
               lang AS extra, true AS keeps_null
        FROM documents WHERE n_chars > 200""",
    "u1_budget": "SELECT doc_id, '2:user:' || left(text, 20) || ':' || (100 + n_chars % 50) AS raw FROM documents",
    "u1_rounds": """
        WITH p AS (SELECT doc_id, text AS topic, 54 + length(text) AS n FROM documents)
        SELECT doc_id, (n % 2)::BIGINT AS round,
               CASE WHEN n % 2 = 0 THEN 'Generate 10 training examples. Cover these 10 topics: '
                    ELSE 'Generate 5 training examples. Cover 5 of these topics: ' END || topic AS instruction,
               4 * (n + CASE WHEN n % 2 = 0 THEN 0 ELSE 1 END) AS n
        FROM p""",
    "e1_sectioned": f"""WITH {SECTIONS}
        SELECT 'prompt ' || page_id AS plan_key, instruction AS prompt, output AS completion, '' AS input,
               'synthetic_lwc_master/part_' || page_id % 10 AS source, 'lwc' AS type, 'Part ' || page_id % 10 AS category,
               'Web' AS domain
        FROM built WHERE page_id % 4 <> 3 AND length(output) > 200""",
    "e1_strict": f"""WITH {SECTIONS}
        SELECT 'prompt ' || page_id AS plan_key, instruction, strict_output AS output, '' AS input, 'synthetic_graphql' AS source, 'lwc' AS type,
               'GraphQL Wire Adapter' AS category
        FROM built WHERE page_id % 3 <> 2 AND length(strict_output) > 200""",
    "e3_batched": """
        SELECT 'MIG-' || doc_id AS call_id, 0::BIGINT AS pos, split_part(text, chr(10), 1) AS instruction, '' AS input,
               text AS output, 'MIG-' || doc_id AS category, 'migration' AS type
        FROM documents WHERE doc_id % 7 < 6 AND n_chars > 200 AND doc_id NOT IN (SELECT doc_id FROM labels)""",
}
