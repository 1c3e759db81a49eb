"""Generation end to end: plan and responses to shaped records.

``responses`` hold one row per attempt: the plan key, stage (0 for the full
prompt, 1 for the fallback prompt), attempt (from 1) and raw text. All attempts
count unless ``max_attempts`` says how many a run makes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators import cleaning, responses as R
from corpusloom.operators.sections import long_enough, section_attempts
from corpusloom.operators.skew import lookup_join


def _first_sectioned(responses: DataFrame, key: str, mode: str, max_attempts: int | None) -> DataFrame:
    tries = section_attempts(R.up_to(responses, max_attempts), mode=mode)
    ok = long_enough(F.col("example.output"))
    first = R.first_acceptable(tries, [key], F.col("attempt"), "example", ok)
    return first.select(key, "example.instruction", "example.output")


def sectioned_results(
    plan: DataFrame, responses: DataFrame, key: str = "prompt", max_attempts: int | None = None
) -> DataFrame:
    """First acceptable lenient response per plan row, repaired and shaped.

    ``plan``: key, category, domain. The key stays as ``plan_key``.
    """
    first = _first_sectioned(responses, key, "lenient", max_attempts)
    rows = lookup_join(plan.select(key, "category", "domain"), first, key, "inner")
    fixed = cleaning.drop_bad_tests(cleaning.fix_examples(rows))
    return cleaning.shape_sectioned(fixed.withColumnRenamed(key, "plan_key"), "plan_key")


def strict_results(responses: DataFrame, key: str = "prompt", max_attempts: int | None = None) -> DataFrame:
    """First acceptable strict response per prompt, as it came, with constant provenance."""
    first = _first_sectioned(responses, key, "strict", max_attempts)
    return cleaning.shape_strict(first.withColumnRenamed(key, "plan_key"), "plan_key")


def batch_results(
    responses: DataFrame, type_name: str, key: str = "call_id", max_attempts: int | None = None
) -> DataFrame:
    """Records of the first acceptable list response per call, tagged by call."""
    tries = R.batch_attempts(R.up_to(responses, max_attempts))
    order = R.attempt_order(F.col("stage"), F.col("attempt"))
    first = R.first_acceptable(tries, [key], order, "records", F.size("records") > 0)
    return cleaning.tag_by_call(R.explode_records(first, key), type_name, key)


def object_results(responses: DataFrame, key: str = "call_id", max_attempts: int | None = None) -> DataFrame:
    """Records of the first response per call that is JSON, typed by call id.

    An empty list ends the call without records, as any parsed response does.
    """
    tries = R.object_attempts(R.up_to(responses, max_attempts))
    first = R.first_acceptable(tries, [key], F.col("attempt"), "elements", F.col("elements").isNotNull())
    return cleaning.derive_from_call(R.object_records(first, key), key)
