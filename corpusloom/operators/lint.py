"""Policies that prose states and a pattern can test, one row per example and rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rule name, lower-case text every match holds, pattern that must
# be found, pattern that must not.
RULES = (
    ("placeholder", "//", r"(?i)//\s*(?:todo|implement|add logic here)", None),
    ("missing_sharing", "class", r"\bclass\s+\w+", r"(?i)\b(?:with|without|inherited)\s+sharing\b"),
    ("no_security", "select", r"(?i)\[\s*select\s", r"(?i)\bwith\s+security_enforced\b"),
    ("hardcoded_id", "'", r"'(?:001|003|005|006|500|a0[0-9A-Za-z])[0-9A-Za-z]{12}(?:[0-9A-Za-z]{3})?'", None),
    ("trivial_assert", "system.assert", r"(?i)\bSystem\.assert\s*\(\s*true\s*\)", None),
    ("deprecated_if", "if:", r"\bif:(?:true|false)\s*=", None),
    ("inline_style", "style", r"\sstyle\s*=\s*[\"']", None),
)


def _hit(text: Column, lower: Column, literal: str, present: str, absent: str | None) -> Column:
    """Texts without the literal are done after a plain search."""
    found = text.rlike(present)
    if absent:
        found = found & ~text.rlike(absent)
    return F.when(F.contains(lower, F.lit(literal)), found).otherwise(F.lit(False))


def lint(df: DataFrame, *keep: str, text: str = "output") -> DataFrame:
    """(kept columns, rule, hit): every rule for every example.

    The rules are constants of the expression, compiled once per task; the rows
    unfold in place.
    """
    lower = F.col("_lower")
    hits = F.array(
        *[F.struct(F.lit(name).alias("rule"), _hit(F.col(text), lower, *rest).alias("hit")) for name, *rest in RULES]
    )
    return df.withColumn("_lower", F.lower(text)).select(*keep, F.inline(hits))


def lint_counts(hits: DataFrame) -> DataFrame:
    return hits.groupBy("rule").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("hit").cast("int").cast("long")).alias("hits")
    )
