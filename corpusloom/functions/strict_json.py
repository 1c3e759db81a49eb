"""Strict JSON parsing and type tests on VARIANT columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_END = "\u241eend\u241e"


def with_json(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: the text parsed as exactly one JSON value, null if it is not.

    The Spark parser alone ignores text behind the value. Parsing the text as
    the first of two list elements, the second a fixed mark, refuses such tails
    and needs one parse only.
    """
    pair = F.try_parse_json(F.concat(F.lit("["), F.col(text), F.lit(f',"{_END}"]')))
    parsed = F.when(
        F.try_variant_get(F.col("_pair"), "$[1]", "string") == _END,
        F.try_variant_get(F.col("_pair"), "$[0]", "variant"),
    )
    return df.withColumn("_pair", pair).withColumn(out, parsed).drop("_pair")


def as_list(v: Column) -> Column:
    """The elements of a JSON list, null for any other kind."""
    return F.try_variant_get(v, "$", "array<variant>")


def as_object(v: Column) -> Column:
    """The members of a JSON object, null for any other kind."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def is_string(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False))


def as_string(v: Column) -> Column:
    """The value of a JSON string, null for any other kind."""
    return F.when(is_string(v), F.try_variant_get(v, "$", "string"))


def as_text(v: Column) -> Column:
    """Strings as they are, JSON null and missing as null, other kinds as JSON."""
    return (
        F.when(is_string(v), F.try_variant_get(v, "$", "string"))
        .when(v.isNull() | F.is_variant_null(v), F.lit(None).cast("string"))
        .otherwise(F.to_json(v))
    )


def as_number(v: Column) -> Column:
    """Numbers as double, booleans as 0 or 1, null for any other kind."""
    numeric = F.schema_of_variant(v).rlike("^(BIGINT|DOUBLE|DECIMAL|BOOLEAN)")
    return F.when(numeric, F.try_variant_get(v, "$", "double"))


def size_of(v: Column) -> Column:
    """``len()`` of a string, list or object; null where Python would raise."""
    return F.coalesce(
        F.length(as_string(v)),
        F.when(as_list(v).isNotNull(), F.size(as_list(v))),
        F.when(as_object(v).isNotNull(), F.size(as_object(v))),
    )
