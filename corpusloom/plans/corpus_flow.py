"""Whole generation runs: plan, resume, responses, records, sinks and counts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators import cleaning, planning, reports
from corpusloom.operators import responses as R
from corpusloom.operators.skew import lookup_join
from corpusloom.operators.winners import sifted
from corpusloom.plans.generation_flow import sectioned_results
from corpusloom.session import own_tables, stage, work_dir
from corpusloom.sources import calls, jsonl, manifest

LOG, FINAL, CATEGORIES = "log", "final", "categories"


@dataclass
class SectionedCorpus:
    """``new`` and ``earlier`` count the rows of the data set; the frames read what was written."""

    new: int
    earlier: int
    final: DataFrame
    shortfall: DataFrame
    status: DataFrame


def logged_examples(log: DataFrame) -> DataFrame:
    """The examples of a {prompt, example} log, read leniently or strictly, in the shape of the data set."""
    kind = dict(log.dtypes)["example"]
    if kind == "variant":
        log = log.where("has_example")
        columns = [F.try_variant_get("example", f"$.{c}", "string").alias(c) for c in jsonl.SECTIONED.names]
    else:
        log = log.where(F.col("example").isNotNull())
        names = log.select("example.*").columns
        columns = [(F.col(f"example.{c}") if c in names else F.lit(None).cast("string")).alias(c) for c in jsonl.SECTIONED.names]
    return log.select(F.col("prompt").alias("plan_key"), *columns)


def sectioned_corpus(
    plan: DataFrame, responses: DataFrame, out: str, log: DataFrame | None = None,
    target: int = planning.TARGET_PER_CATEGORY, max_attempts: int | None = R.SECTION_ATTEMPTS,
) -> SectionedCorpus:
    """The first ``target`` prompts of each category to one data set below ``out``, going on from ``log``.

    ``plan``: category, ordinal, prompt, domain. ``responses``: prompt, attempt, raw,
    scanned once. ``log``: what earlier runs have, as jsonl.tolerant_log or
    strict_log reads it; its prompts are done, with an example or without.

    One write makes the log of this run ({prompt, example} lines, below part=log),
    the data set of earlier and new rows (part=final) and a line per row with its
    category alone, from which the counts come (part=categories).
    """
    spark = plan.sparkSession
    capped = planning.cap_per_category(plan, target)
    with own_tables(spark):
        todo = capped if log is None else planning.remaining_work(capped, log, "prompt")
        new = sectioned_results(todo, responses, max_attempts=max_attempts).withColumn("_new", F.lit(True))
        rows = new if log is None else cleaning.union_results(logged_examples(log).withColumn("_new", F.lit(False)), new)
        seen = Observation()
        rows = rows.observe(seen, F.count_if("_new").alias("new"), F.count_if(~F.col("_new")).alias("earlier"))
        record = F.struct(*jsonl.SECTIONED.names)
        logged = F.struct(F.col("plan_key").alias("prompt"), record.alias("example"))

        def line(part: str, value: Column) -> Column:
            return F.struct(F.lit(part).alias("part"), value.alias("value"))

        keep_nulls = {"ignoreNullFields": "false"}
        both = F.array(line(FINAL, F.to_json(record, keep_nulls)), line(CATEGORIES, F.to_json(F.struct("category"))))
        lines = F.when(F.col("_new"), F.concat(F.array(line(LOG, F.to_json(logged, keep_nulls))), both)).otherwise(both)
        rows.select(F.inline(lines)).write.mode("overwrite").partitionBy("part").text(out)
        counts = seen.get
    return SectionedCorpus(
        counts["new"], counts["earlier"], _part(spark, out, FINAL, jsonl.SECTIONED),
        reports.shortfall(_categories(spark, out), target), _status(spark, capped, log, out, target),
    )


def _part(spark: SparkSession, out: str, part: str, schema: T.StructType) -> DataFrame:
    place = f"{out}/part={part}"
    return spark.read.schema(schema).json(place) if manifest.exists(spark, place) else spark.createDataFrame([], schema)


def _categories(spark: SparkSession, out: str) -> DataFrame:
    return _part(spark, out, CATEGORIES, jsonl.strings("category"))


def _status(spark: SparkSession, capped: DataFrame, log: DataFrame | None, out: str, target: int) -> DataFrame:
    """Done and remaining per planned category, after this run."""
    done = _part(spark, out, LOG, jsonl.strings("prompt"))
    if log is not None:
        done = done.unionByName(log.select("prompt"))
    left = planning.remaining_work(capped.select("category", "prompt"), done, "prompt")
    return planning.plan_status(capped, _categories(spark, out), left, target)


@dataclass
class Family:
    """How the answers of a kind of call become records."""

    parse: Callable[[DataFrame], DataFrame]
    value: str
    ok: Column
    records: Callable[[DataFrame, str], DataFrame]
    rounds: Sequence[tuple[int, int]]


def batch_family(type_name: str, attempts: int = R.BATCH_ATTEMPTS) -> Family:
    """Lists of records, tagged by their call: ``attempts`` with the full prompt, then as many with the fallback."""
    def records(first: DataFrame, key: str) -> DataFrame:
        rows = cleaning.tag_by_call(R.explode_records(first, key), type_name, key)
        return rows.withColumn("record", R.open_record(F.col("record"), category=F.col("category"), type=F.col("type")))

    rounds = [(s, a) for s in (0, 1) for a in range(1, attempts + 1)]
    return Family(R.batch_attempts, "records", F.size("records") > 0, records, rounds)


def object_family(attempts: int = R.OBJECT_ATTEMPTS) -> Family:
    """Lists or lone objects, typed by their call; any JSON ends a call, with records or without."""
    def records(first: DataFrame, key: str) -> DataFrame:
        return cleaning.derive_from_call(R.object_records(first, key), key)

    return Family(R.object_attempts, "elements", F.col("elements").isNotNull(), records, [(0, a) for a in range(1, attempts + 1)])


@dataclass
class CallCorpus:
    """``parsed`` counts the answers looked into; ``open_calls`` are planned calls without an acceptable one."""

    parsed: int
    records: DataFrame
    files: DataFrame
    open_calls: DataFrame


def call_corpus(plan: DataFrame, responses: DataFrame, out: str, family: Family, key: str = "call_id") -> CallCorpus:
    """The records of every planned call below ``out``, going on from what is there.

    ``plan``: call id, ordinal, filename. ``responses``: call id, stage, attempt, raw;
    laid out by stage and attempt, as rounds of calls leave them, each round reads
    its own folder. A round looks into answers of calls that are open still, which a sieve
    of their hashes finds where they lie: an answer behind an acceptable one is parsed only
    where two hashes meet, and never taken. Calls that end a run are kept with
    their records, so a call whose answer holds none is finished, too.
    """
    spark = plan.sparkSession
    finished, stored = f"{out}/finished", f"{out}/calls"
    with own_tables(spark):
        todo = plan.select(key).distinct()
        if manifest.latest(spark, finished)[0] >= 0:
            todo = planning.remaining_work(todo, calls.read_calls(spark, finished), key, unique=True)
        todo = stage(todo, work_dir(spark, "open"))
        won, parsed = [], 0
        for stage_no, attempt in family.rounds:
            answers = responses.where((F.col("stage") == stage_no) & (F.col("attempt") == attempt)).select(key, "raw")
            seen = Observation()
            asked = sifted(answers, todo, key).observe(seen, F.count(F.lit(1)).alias("n"))
            first = R.first_acceptable(family.parse(asked), [key], F.lit(0), family.value, family.ok, among=todo)
            parsed += seen.get["n"]
            won.append(first)
            todo = stage(planning.remaining_work(todo, first, key, unique=True), work_dir(spark, "open"))
            if todo.isEmpty():
                break
        first = won[0]
        for more in won[1:]:
            first = first.unionByName(more)
        files = plan.groupBy(key).agg(F.min("filename").alias("filename"))
        calls.overwrite_calls(lookup_join(family.records(first, key), files, key, "left"), stored, key)
        # behind the records: a run that stops in between writes them again
        calls.overwrite_calls(first.select(key), finished, key)
    records = calls.read_calls(spark, stored)
    done = calls.read_calls(spark, finished)
    counts = reports.planned_file_counts(plan.select("ordinal", "filename"), records)
    return CallCorpus(parsed, records, counts, planning.remaining_work(plan, done, key))
