"""Quality verdicts: enforce, default, attach, resume, split."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import round_half_even
from corpusloom.operators.planning import remaining_work
from corpusloom.operators.responses import OBJECT_ATTEMPTS, SCORES, first_acceptable, up_to, verdict_attempts
from corpusloom.operators.skew import lookup_join
from corpusloom.operators.winners import winning_rows

# The acceptance rule and the text of a missing verdict.
MIN_SCORE = 3
MIN_AVERAGE = 3.5
ACCEPT, REJECT = "accept", "reject"
JUDGE_ERROR = f"Judge error after {OBJECT_ATTEMPTS} attempts"

VERDICT_COLUMNS = (*SCORES, "avg_score", "verdict", "reason")


def content_key(instruction: Column, output: Column) -> Column:
    """Stable identity of an example; exact copies share it.

    The length tells where the instruction ends, so no two examples run together.
    """
    blank = F.lit("")
    asked, given = F.coalesce(instruction, blank), F.coalesce(output, blank)
    return F.sha2(F.concat(F.length(asked).cast("string"), F.lit(":"), asked, given), 256)


def with_content_key(df: DataFrame) -> DataFrame:
    return df.withColumn("content_key", content_key(F.col("instruction"), F.col("output")))


def judge_work(examples: DataFrame, judged: DataFrame | None = None) -> DataFrame:
    """One row per distinct content without a usable verdict, and its copy count.

    Copies combine by their keys alone, inside each task ahead of the shuffle; the
    texts of one of them are fetched afterwards. Examples with a usable verdict leave first.
    """
    rows = examples.select("content_key", "instruction", "output")
    if judged is not None:
        rows = remaining_work(rows, resumable(judged), "content_key")
    return winning_rows(rows, ["content_key"], count="copies")


def enforce(df: DataFrame) -> DataFrame:
    """Average and verdict from the scores; the judge's own verdict is ignored."""
    total = reduce(lambda a, b: a + b, [F.col(s).cast("double") for s in SCORES])
    df = df.withColumn("avg_score", round_half_even(total / 4, 2))
    passed = (F.least(*SCORES) >= MIN_SCORE) & (F.col("avg_score") >= MIN_AVERAGE)
    return df.withColumn("verdict", F.when(passed, ACCEPT).otherwise(REJECT))


def verdicts_from_responses(
    responses: DataFrame, key: str = "content_key", attempt: str = "attempt", max_attempts: int | None = None
) -> DataFrame:
    """Judge responses to one enforced verdict per key.

    The first valid attempt counts; later ones and those over a limit do not.
    """
    tries = verdict_attempts(up_to(responses, max_attempts, attempt))
    first = first_acceptable(tries, [key], F.col(attempt), "verdict", F.col("verdict").isNotNull())
    scores = first.select(key, *[F.col(f"verdict.{s}").alias(s) for s in SCORES], F.col("verdict.reason").alias("reason"))
    return enforce(scores).select(key, *VERDICT_COLUMNS)


def with_default(df: DataFrame) -> DataFrame:
    """Rows without a verdict become zero-score rejects."""
    missing = F.col("verdict").isNull()
    return df.withColumns(
        {s: F.coalesce(F.col(s).cast("double"), F.lit(0.0)) for s in (*SCORES, "avg_score")}
        | {
            "reason": F.when(missing, JUDGE_ERROR).otherwise(F.col("reason")),
            "verdict": F.coalesce("verdict", F.lit(REJECT)),
        }
    )


def attach(examples: DataFrame, verdicts: DataFrame, key: str = "content_key") -> DataFrame:
    """Every example with its verdict, copies alike, defaults filled in.

    ``verdicts`` has one row per key, so the join never multiplies rows; a text
    with very many copies is split over several tasks.
    """
    return with_default(lookup_join(examples, verdicts, key, "left"))


def resumable(verdicts: DataFrame) -> DataFrame:
    """Verdicts worth keeping; failed judge calls are judged again."""
    return verdicts.where(F.col("avg_score") > 0)


def accepted(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("verdict") == ACCEPT)


def rejected(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("verdict") == REJECT)


def without_verdict(judged: DataFrame) -> DataFrame:
    """The examples as they came in."""
    return judged.drop(*VERDICT_COLUMNS, "content_key")


def nest_verdict(judged: DataFrame) -> DataFrame:
    """Verdict columns folded into one ``_qc`` struct."""
    qc = F.struct(*VERDICT_COLUMNS).alias("_qc")
    return judged.select(*without_verdict(judged).columns, qc)
