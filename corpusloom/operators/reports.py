"""Counts and rates over judged and generated records.

Every report combines inside each task before its shuffle, so one category or
file holding most rows costs no more than the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import line_count, round_half_even
from corpusloom.operators.judging import ACCEPT, REJECT
from corpusloom.operators.planning import TARGET_PER_CATEGORY
from corpusloom.operators.skew import lookup_join

UNKNOWN = "unknown"


def _count_if(cond: Column) -> Column:
    return F.coalesce(F.sum(F.when(cond, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"))


def _percent(part: Column, whole: Column) -> Column:
    return round_half_even(part / F.greatest(whole, F.lit(1)) * 100, 1)


def qc_summary(judged: DataFrame) -> DataFrame:
    """One row: totals, acceptance rate, mean scores of both sides."""
    is_ok, is_bad = F.col("verdict") == ACCEPT, F.col("verdict") == REJECT
    sums = judged.agg(
        F.count(F.lit(1)).alias("total"),
        _count_if(is_ok).alias("accepted"),
        _count_if(is_bad).alias("rejected"),
        F.coalesce(F.sum(F.when(is_ok, F.col("avg_score"))), F.lit(0.0)).alias("_ok"),
        F.coalesce(F.sum(F.when(is_bad, F.col("avg_score"))), F.lit(0.0)).alias("_bad"),
    )
    return sums.select(
        "total",
        "accepted",
        "rejected",
        _percent(F.col("accepted"), F.col("total")).alias("acceptance_rate"),
        round_half_even(F.col("_ok") / F.greatest("accepted", F.lit(1)), 2).alias("avg_score_accepted"),
        round_half_even(F.col("_bad") / F.greatest("rejected", F.lit(1)), 2).alias("avg_score_rejected"),
    )


def pass_rate_by_category(judged: DataFrame) -> DataFrame:
    counts = judged.groupBy(F.coalesce("category", F.lit(UNKNOWN)).alias("category")).agg(
        _count_if(F.col("verdict") == ACCEPT).alias("accept"),
        _count_if(F.col("verdict") == REJECT).alias("reject"),
    )
    return counts.withColumn("pass_rate", _percent(F.col("accept"), F.col("accept") + F.col("reject")))


def worst_categories(by_category: DataFrame, n: int = 5) -> DataFrame:
    return by_category.orderBy("pass_rate", "category").limit(n)


def report_json(summary: DataFrame, by_category: DataFrame, judge: str) -> DataFrame:
    """The report as one JSON object per row: first the summary, then a row per category."""
    head = summary.select(F.to_json(F.struct(F.lit(judge).alias("judge"), "*")).alias("value"))
    rows = by_category.select(F.to_json(F.struct("category", "accept", "reject", "pass_rate")).alias("value"))
    return head.unionByName(rows)


def shortfall(results: DataFrame, target: int = TARGET_PER_CATEGORY) -> DataFrame:
    """Rows per category and how many are missing; empty categories are absent."""
    counts = results.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("short", F.greatest(F.lit(target) - F.col("n"), F.lit(0).cast("long")))


def file_counts(records: DataFrame, file: str = "filename") -> DataFrame:
    """Rows per file and, with a null file, of all files together.

    The total is rolled up over the counts, not over the records.
    """
    counts = records.groupBy(file).agg(F.count(F.lit(1)).alias("n"))
    return counts.rollup(file).agg(F.sum("n").alias("n"), F.grouping(file).cast("long").alias("is_total"))


def planned_file_counts(plan: DataFrame, records: DataFrame) -> DataFrame:
    """Counts of the planned files that exist, in plan order, and their total.

    ``plan``: ordinal, filename. A file is listed once per plan row that names
    it, and counts as often in the total.
    """
    counts = records.groupBy("filename").agg(F.count(F.lit(1)).alias("n"))
    listed = lookup_join(plan, counts, "filename", "inner").select(F.struct("ordinal", "filename").alias("file"), "n")
    totals = listed.rollup("file").agg(F.sum("n").alias("n"), F.grouping("file").cast("long").alias("is_total"))
    return totals.select("file.ordinal", "file.filename", "n", "is_total")


def output_lines(df: DataFrame, col: str = "output") -> DataFrame:
    return df.withColumn("n_lines", line_count(F.col(col)))
