"""Resumable jobs: Structured Streaming over arriving responses.

Each micro-batch is written to a log under its own id, so a batch that runs again
after a failure replaces itself, and the checkpoint remembers what was read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators.judging import resumable, verdicts_from_responses
from corpusloom.operators.reports import pass_rate_by_category
from corpusloom.operators.responses import batch_attempts, explode_records, first_acceptable, open_record
from corpusloom.session import own_tables
from corpusloom.sources import manifest
from corpusloom.streaming.log import BATCH, COMMIT, RUN, append_batch, open_log


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The name of the run that a checkpoint belongs to; it is kept beside the checkpoint."""
    place = f"{checkpoint.rstrip('/')}-run"
    manifest.put_text(spark, place, uuid.uuid4().hex)  # leaves that of an earlier start alone
    return manifest.get_text(spark, place)


def run_generation(
    responses: DataFrame,
    parse: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    schema: T.StructType,
    key: str,
) -> StreamingQuery:
    """Parse arriving responses and log the records of each key once; failures stay open.

    ``parse`` maps raw attempts to rows of ``schema``: of each key the records of
    one answer, however many they are (:func:`first_records`).
    """
    spark = responses.sparkSession
    open_log(spark, path, schema)
    run = run_of(spark, checkpoint)

    def step(batch: DataFrame, batch_id: int) -> None:
        with own_tables(spark):
            append_batch(parse(batch), batch_id, path, schema, key, run=run)

    return (
        responses.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def first_records(batch: DataFrame, key: str = "call_id", attempt: str = "attempt") -> DataFrame:
    """All records of the first acceptable answer per key: (key, pos, texts, the open record as JSON)."""
    first = first_acceptable(batch_attempts(batch), [key], F.col(attempt), "records", F.size("records") > 0)
    rows = explode_records(first, key)
    return rows.withColumn("record", open_record(F.col("record")))


def run_judging(
    responses: DataFrame, path: str, checkpoint: str, schema: T.StructType, max_attempts: int | None = None
) -> StreamingQuery:
    """Log a verdict per content key; keys with a usable verdict are settled."""
    spark = responses.sparkSession
    open_log(spark, path, schema)
    run = run_of(spark, checkpoint)

    def step(batch: DataFrame, batch_id: int) -> None:
        with own_tables(spark):
            verdicts = verdicts_from_responses(batch, max_attempts=max_attempts)
            append_batch(verdicts, batch_id, path, schema, "content_key", done=resumable, run=run)

    return (
        responses.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def settled_verdicts(log: DataFrame, key: str = "content_key") -> DataFrame:
    """One verdict per key of a log: a usable one before one of a failed judge call, then the one committed last."""
    order = F.struct((F.col("avg_score") > 0).alias("usable"), COMMIT)
    names = [c for c in log.columns if c not in (key, RUN, BATCH, COMMIT)]
    best = log.groupBy(key).agg(F.max_by(F.struct(*names), order).alias("best"))
    return best.select(key, "best.*")


def run_report(judged: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Pass rate by category, published anew as rows arrive; read it by ``manifest.read_published``.

    The state is one row per category however many examples arrive. A reader
    finds the report of one batch or of the next, never an empty place.
    """
    def publish(report: DataFrame, batch_id: int) -> None:
        manifest.publish(report, path, f"report-{batch_id}")

    return (
        pass_rate_by_category(judged)
        .writeStream.outputMode("complete")
        .foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
