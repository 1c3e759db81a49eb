"""Streaming jobs, run to the end of what is there and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import fixtures as fx
from corpusloom.catalog.sql import JUDGED
from corpusloom.operators import judging
from corpusloom.operators.responses import OBJECT_ATTEMPTS
from corpusloom.session import work_dir
from corpusloom.sources import manifest
from corpusloom.streaming import incremental as I
from corpusloom.streaming import log as L

RECORDS = T.StructType(
    [T.StructField("call_id", T.StringType()), T.StructField("pos", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in ("instruction", "input", "output", "record")]
)
VERDICTS = T.StructType(
    [T.StructField("content_key", T.StringType())]
    + [T.StructField(s, T.DoubleType()) for s in (*judging.SCORES, "avg_score")]
    + [T.StructField("verdict", T.StringType()), T.StructField("reason", T.StringType())]
)


def arriving(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The files of a table, be it one file or a folder of them.

    A pattern, because a stream takes no path of a single file.
    """
    schema = fx.table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{{{name}.parquet}}")


def as_answers(documents: DataFrame) -> DataFrame:
    """Two answers per call, the first one broken for every fourth; three records each, the middle one too short."""
    line = fx.first_line(F.col("text"))
    records = F.array(
        F.struct(line.alias("instruction"), F.col("text").alias("output"), F.col("lang").alias("extra")),
        F.struct(line.alias("instruction"), F.lit("short").alias("output"), F.lit("x").alias("extra")),
        F.struct(line.alias("instruction"), F.concat("text", F.lit(" "), "text").alias("output"), F.lit("two").alias("extra")),
    )
    raw = F.concat(F.lit(f"{fx.FENCE}json\n"), F.to_json(records), F.lit(f"\n{fx.FENCE}"))
    tries = documents.select("doc_id", F.concat(F.lit("MIG-"), "doc_id").alias("call_id"), raw.alias("raw"), F.explode(F.array(F.lit(1), F.lit(2))).alias("attempt"))
    broken = (F.col("attempt") == 1) & (F.col("doc_id") % 4 == 0)
    return tries.withColumn("raw", F.when(broken, F.left("raw", F.length("raw") - 20)).otherwise(F.col("raw")))


def stream_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, checkpoint = work_dir(spark, "generation"), work_dir(spark, "generation-checkpoint")
    # the test table is one split, as fixtures.texts says
    arrivals = as_answers(arriving(spark, sf_dir, "documents").repartition(spark.sparkContext.defaultParallelism))
    I.run_generation(arrivals, I.first_records, path, checkpoint, RECORDS, "call_id").awaitTermination()
    log = L.read_log(spark, path, RECORDS)
    return log.select("call_id", "pos", "instruction", "input", "output", F.get_json_object("record", "$.extra").alias("extra"))


def stream_judge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses written as a table, then judged as a stream in several batches."""
    source, path, checkpoint = (work_dir(spark, n) for n in ("answers", "verdicts", "verdicts-checkpoint"))
    answers = fx.judge_responses(spark, sf_dir)
    answers.repartition(4, "content_key").write.parquet(source)
    arrivals = spark.readStream.schema(answers.schema).option("maxFilesPerTrigger", 2).parquet(source)
    I.run_judging(arrivals, path, checkpoint, VERDICTS, OBJECT_ATTEMPTS).awaitTermination()
    verdicts = I.settled_verdicts(L.read_log(spark, path, VERDICTS))
    ex = judging.with_content_key(fx.examples(spark, sf_dir))
    return ex.join(verdicts, "content_key").select("doc_id", *judging.VERDICT_COLUMNS)


def idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch 0 runs twice, batch 1 of another run brings everything again: each key's records stay once."""
    path = work_dir(spark, "replayed")
    docs = fx.table(spark, sf_dir, "documents")
    rows, half = (I.first_records(as_answers(d)) for d in (docs, docs.where("doc_id % 2 = 0")))
    L.open_log(spark, path, RECORDS)
    for run, batch_id, batch in (("a", 0, half), ("a", 0, half), ("b", 0, rows), ("b", 0, rows), ("b", 1, half)):
        L.append_batch(batch, batch_id, path, RECORDS, "call_id", run=run)
    log = L.read_log(spark, path, RECORDS)
    return log.groupBy("call_id").agg(F.count(F.lit(1)).alias("n"), F.max(L.RUN).alias("run"), F.max(L.BATCH).alias("batch"))


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine batches, each of which brings the keys of the one before once more; folders are merged by threes."""
    path = work_dir(spark, "merged")
    docs = fx.table(spark, sf_dir, "documents").select(F.concat(F.lit("MIG-"), "doc_id").alias("call_id"), F.col("doc_id").alias("pos"), "text")
    schema = T.StructType([T.StructField("call_id", T.StringType()), T.StructField("pos", T.LongType()), T.StructField("text", T.StringType())])
    L.open_log(spark, path, schema)
    for n in range(9):
        batch = docs.where(F.col("pos") % 9 == n).unionByName(docs.where(F.col("pos") % 9 == n - 1))
        L.append_batch(batch, n, path, schema, "call_id", fanout=3, bucket_rows=64)
    log = L.read_log(spark, path, schema)
    return log.select("call_id", F.length("text").cast("long").alias("n_chars"), F.col(L.BATCH).alias("batch"))


def running(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, checkpoint = work_dir(spark, "report"), work_dir(spark, "report-checkpoint")
    docs = arriving(spark, sf_dir, "documents").withColumn("category", F.col("source"))
    I.run_report(judging.enforce(fx.with_scores(docs)), path, checkpoint).awaitTermination()
    return manifest.read_published(spark, path)


QUERIES = {
    "i1_stream_parse": stream_parse,
    "i2_stream_judge": stream_judge,
    "i3_idempotent": idempotent,
    "i3_merged": merged,
    "i4_running": running,
}

ORACLES = {
    "i1_stream_parse": """
        SELECT 'MIG-' || doc_id AS call_id, pos, split_part(text, chr(10), 1) AS instruction, '' AS input, output, extra
        FROM (SELECT doc_id, text, 0::BIGINT AS pos, text AS output, lang AS extra FROM documents
              UNION ALL SELECT doc_id, text, 2, text || ' ' || text, 'two' FROM documents)
        WHERE length(output) > 200""",
    "i2_stream_judge": f"""WITH {JUDGED}
        SELECT doc_id, completeness, alignment, best_practices, code_quality, avg_score, verdict, reason
        FROM judged WHERE avg_score > 0""",
    "i3_idempotent": """
        SELECT 'MIG-' || doc_id AS call_id, (CASE WHEN n_chars > 200 THEN 2 ELSE 1 END)::BIGINT AS n,
               CASE WHEN doc_id % 2 = 0 THEN 'a' ELSE 'b' END AS run, 0::BIGINT AS batch
        FROM documents WHERE 2 * n_chars + 1 > 200""",
    "i3_merged": "SELECT 'MIG-' || doc_id AS call_id, length(text) AS n_chars, doc_id % 9 AS batch FROM documents",
    "i4_running": """
        WITH m AS (
          SELECT source AS category, 2 + (doc_id * 7 + n_chars) % 4 AS a, 2 + (doc_id * 3 + n_chars * 5) % 4 AS b,
                 2 + (doc_id * 11 + n_chars * 3) % 4 AS c, 2 + (doc_id + n_chars * 7) % 4 AS d
          FROM documents),
        v AS (SELECT category, least(a, b, c, d) >= 3 AND a + b + c + d >= 14 AS ok FROM m)
        SELECT category, count(*) FILTER (ok) AS accept, count(*) FILTER (NOT ok) AS reject,
               round_even(count(*) FILTER (ok) / count(*)::DOUBLE * 100, 1) AS pass_rate
        FROM v GROUP BY 1""",
}
