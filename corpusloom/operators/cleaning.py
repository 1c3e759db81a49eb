"""Repairs, filters and shaping of parsed examples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import WS

# The patterns of the repair rules, flags spelled for Java.
PRIMITIVE_TRACK = (
    rf"(?U)(@track{WS}+)(\w+{WS}*={WS}*"
    rf"(?:'[^']*'|\"[^\"]*\"|\d+(?:\.\d+)?|true|false|null){WS}*;)"
)
LOADING_GETTER = rf"(?U)\bget{WS}+isLoading{WS}*\("
LOADING_FIELD = rf"(?md)^({WS}{{4}}isLoading{WS}*={WS}*(?:true|false){WS}*;[ \t]*\n)"
FENCED_CSS = rf"(?sU)(/\*{WS}*[\w-]+\.css{WS}*\*/{WS}*\n){WS}*```css{WS}*\n(.*?)\n```"
DOUBLE_HEADER = (
    rf"(?mdU)^(<!--{WS}*[\w-]+\.html{WS}*-->){WS}*\n(<!--{WS}*[\w-]+\.html{WS}*-->)"
)
TEST_CALL = rf"(?U)\b(?:describe|it|test){WS}*\("
# Phrases that make an instruction one about tests.
TEST_PHRASES = ("jest", "unit test", "test file", "write test", "tests for")
# Provenance of sectioned records, lenient and strict.
SECTION_SOURCE = "synthetic_lwc_master/"
SECTION_TYPE = "lwc"
STRICT_SOURCE = "synthetic_graphql"
STRICT_CATEGORY = "GraphQL Wire Adapter"


def _where(text: Column, literal: str, fixed: Column) -> Column:
    """Most texts lack the literal a rule needs and skip its pattern."""
    return F.when(F.contains(text, F.lit(literal)), fixed).otherwise(text)


def untrack_primitives(text: Column) -> Column:
    return _where(text, "@track", F.regexp_replace(text, PRIMITIVE_TRACK, "$2"))


def drop_loading_field(text: Column) -> Column:
    """Only where a getter of the same name makes the field redundant."""
    fixed = F.when(text.rlike(LOADING_GETTER), F.regexp_replace(text, LOADING_FIELD, "")).otherwise(text)
    return _where(text, "isLoading", fixed)


def unfence_css(text: Column) -> Column:
    return _where(text, "```css", F.regexp_replace(text, FENCED_CSS, "$1$2"))


def merge_headers(text: Column) -> Column:
    """Of two adjacent headers keep the second; three become two."""
    return _where(text, "<!--", F.regexp_replace(text, DOUBLE_HEADER, "$2"))


RULES = {
    "track": untrack_primitives,
    "loading": drop_loading_field,
    "css": unfence_css,
    "header": merge_headers,
}


def fix_examples(df: DataFrame, col: str = "output", changed: bool = False) -> DataFrame:
    """All repair rules in order; ``changed`` adds one flag per rule.

    Each step is its own staged column, so a rule that looks at its input twice
    does not repeat the rules ahead of it.
    """
    for name, rule in RULES.items():
        df = df.withColumn("_fixed", rule(F.col(col)))
        if changed:
            df = df.withColumn(f"{name}_changed", F.col("_fixed") != F.col(col))
        df = df.withColumn(col, F.col("_fixed")).drop("_fixed")
    return df


def is_bad_test(instruction: Column, output: Column) -> Column:
    """An example about tests whose output holds no test."""
    asked = F.lower(F.coalesce(instruction, F.lit("")))
    about_tests = reduce(lambda a, b: a | b, [F.contains(asked, F.lit(p)) for p in TEST_PHRASES])
    return about_tests & ~output.rlike(TEST_CALL)


def drop_bad_tests(df: DataFrame, instruction: str = "instruction", output: str = "output") -> DataFrame:
    return df.where(~is_bad_test(F.col(instruction), F.col(output)))


def slug(category: Column) -> Column:
    return F.translate(F.lower(category), " /()", "__")


def shape_sectioned(df: DataFrame, *keep: str) -> DataFrame:
    """Rename to prompt and completion, add provenance; ``keep`` stays in front."""
    return df.select(
        *keep,
        F.col("instruction").alias("prompt"),
        F.col("output").alias("completion"),
        F.lit("").alias("input"),
        F.concat(F.lit(SECTION_SOURCE), slug(F.col("category"))).alias("source"),
        F.lit(SECTION_TYPE).alias("type"),
        "category",
        F.coalesce("domain", F.lit("Generic")).alias("domain"),
    )


def shape_strict(df: DataFrame, *keep: str) -> DataFrame:
    """Constant provenance; instruction and output keep their names."""
    return df.select(
        *keep,
        "instruction",
        F.lit("").alias("input"),
        "output",
        F.lit(STRICT_SOURCE).alias("source"),
        F.lit(SECTION_TYPE).alias("type"),
        F.lit(STRICT_CATEGORY).alias("category"),
    )


def tag_by_call(df: DataFrame, type_name: str, call_id: str = "call_id") -> DataFrame:
    return df.withColumns({"category": F.col(call_id), "type": F.lit(type_name)})


def derive_from_call(df: DataFrame, call_id: str = "call_id") -> DataFrame:
    """Category is the id up to its first dash, type tells domain from generic."""
    return df.withColumns(
        {
            "category": F.substring_index(call_id, "-", 1),
            "type": F.when(F.contains(F.col(call_id), F.lit("domain")), "domain").otherwise("generic"),
        }
    )


def union_results(done: DataFrame, new: DataFrame) -> DataFrame:
    """Earlier and new records as they are; duplicates stay."""
    return done.unionByName(new, allowMissingColumns=True)
