"""Judging end to end: examples and judge responses to clean, rejected and report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators import judging, reports
from corpusloom.operators.planning import envelope, judge_prompt, remaining_work
from corpusloom.session import own_tables, stage
from corpusloom.sources import jsonl


def judge_requests(
    examples: DataFrame, system: str, template: str, judged: DataFrame | None = None,
    instruction_chars: int | None = None, output_chars: int | None = None,
) -> DataFrame:
    """Content keys still to judge, each with its request messages; whole texts unless a length is given."""
    work = judging.judge_work(judging.with_content_key(examples), judged)
    prompt = judge_prompt(template, F.col("instruction"), F.col("output"), instruction_chars, output_chars)
    return work.select("content_key", envelope(system, prompt).alias("messages"))


def judged_examples(
    examples: DataFrame, responses: DataFrame, earlier: DataFrame | None = None, max_attempts: int | None = None
) -> DataFrame:
    """Every example with its enforced verdict.

    ``responses``: content_key, attempt, raw. ``earlier``: verdicts of former
    runs; usable ones win over new responses. All attempts count unless limited.
    """
    verdicts = judging.verdicts_from_responses(responses, max_attempts=max_attempts)
    if earlier is not None:
        kept = judging.resumable(earlier).select("content_key", *judging.VERDICT_COLUMNS)
        verdicts = kept.unionByName(remaining_work(verdicts, kept, "content_key", unique=True))
    return judging.attach(judging.with_content_key(examples), verdicts)


@dataclass
class JudgedCorpus:
    judged: DataFrame
    summary: DataFrame
    by_category: DataFrame
    worst: DataFrame


def judge_corpus(
    examples: DataFrame,
    responses: DataFrame,
    out: str,
    judge: str,
    earlier: DataFrame | None = None,
    max_attempts: int | None = None,
) -> JudgedCorpus:
    """Write judged, clean, rejected, final and report data sets below ``out``.

    The join runs once. Its result is a table partitioned by verdict: each sink
    reads its own partition and the reports read three narrow columns.
    """
    with own_tables(examples.sparkSession):
        judged = stage(judged_examples(examples, responses, earlier, max_attempts), f"{out}/judged", "verdict")
    jsonl.write_clean(judged, f"{out}/clean")
    jsonl.write_rejects(judged, f"{out}/rejected")
    jsonl.write_merged(judging.without_verdict(judging.accepted(judged)), f"{out}/final")
    summary, by_category = reports.qc_summary(judged), reports.pass_rate_by_category(judged)
    reports.report_json(summary, by_category, judge).write.mode("overwrite").text(f"{out}/report")
    return JudgedCorpus(judged, summary, by_category, reports.worst_categories(by_category))


def judge_records(
    records: DataFrame,
    responses: DataFrame,
    out: str,
    judge: str,
    earlier: DataFrame | None = None,
    max_attempts: int | None = None,
) -> JudgedCorpus:
    """As :func:`judge_corpus` for records of open shape (jsonl.scan_records): all keys reach every sink.

    Rejected records carry their verdict under ``_qc``.
    """
    with own_tables(records.sparkSession):
        rows = judged_examples(records, responses, earlier, max_attempts).drop("instruction", "input", "output", "content_key")
        judged = stage(rows, f"{out}/judged", "verdict")
    jsonl.write_records(judging.accepted(judged), f"{out}/clean", jsonl.ORIGIN)
    jsonl.write_records(judging.accepted(judged), f"{out}/final")
    members = F.try_variant_get(F.parse_json("record"), "$", "map<string,variant>")
    with_verdict = F.map_concat(
        F.map_filter(members, lambda k, _: k != "_qc"),
        F.create_map(F.lit("_qc"), F.to_variant_object(F.struct(*judging.VERDICT_COLUMNS))),
    )
    jsonl.write_records(judging.rejected(judged).withColumn("record", F.to_json(with_verdict)), f"{out}/rejected")
    summary, by_category = reports.qc_summary(judged), reports.pass_rate_by_category(judged)
    reports.report_json(summary, by_category, judge).write.mode("overwrite").text(f"{out}/report")
    return JudgedCorpus(judged, summary, by_category, reports.worst_categories(by_category))
