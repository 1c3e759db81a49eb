"""String and number columns with the exact results Python gives.

Only built-in expressions: everything here stays in the JVM.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters str.isspace() accepts, as text and as a regex class.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# The characters at which str.splitlines() breaks.
BREAK_CHARS = r"\n\x0b\x0c\r\x1c-\x1e\x85\u2028\u2029"


def strip(col: Column) -> Column:
    """``str.strip()``; plain ``trim`` would cut spaces only."""
    return F.trim(col, F.lit(SPACE_CHARS))


def is_blank(col: Column) -> Column:
    return strip(col) == ""


def round_half_even(col: Column, digits: int) -> Column:
    return F.bround(col.cast("double"), digits)


def title_words(col: Column) -> Column:
    """``str.title()``: every run of letters restarts the capital."""
    runs = F.regexp_extract_all(col, F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(F.transform(runs, F.initcap), "")


def line_count(col: Column) -> Column:
    """``len(str.splitlines())``."""
    breaks = F.regexp_count(col, F.lit(rf"\r\n|[{BREAK_CHARS}]"))
    open_end = F.when(col.rlike(rf"[^{BREAK_CHARS}]\z"), 1).otherwise(0)
    return (breaks + open_end).cast("long")


def after_first(col: Column, marker: str) -> Column:
    """Text behind the first marker, null when there is none."""
    at = F.locate(marker, col)
    return F.when(at > 0, F.substr(col, at + F.lit(len(marker))))


def before_first(col: Column, marker: str) -> Column:
    """Text ahead of the first marker, null when there is none."""
    return F.when(F.contains(col, F.lit(marker)), F.substring_index(col, marker, 1))


def with_widest_span(df: DataFrame, col: str, opening: str, closing: str) -> DataFrame:
    """Cut a column to the span from its first opening to its last closing character.

    A text without such a span stays whole. This is what a greedy dot-all regex
    finds, taken by position in linear time.
    """
    text, first, last = F.col(col), F.col("_first"), F.col("_last")
    df = df.withColumn("_first", F.locate(opening, text)).withColumn(
        "_last", F.length(text) - F.length(F.substring_index(text, closing, -1))
    )
    cut = F.when((first > 0) & (last > first), F.substr(text, first, last - first + 1)).otherwise(text)
    return df.withColumn(col, cut).drop("_first", "_last")


def render(template: str, **fields: Column) -> Column:
    """``template.format(**fields)`` for one template known up front."""
    parts: list[Column] = []
    for literal, name, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            parts.append(fields[name])
    return F.concat(*parts)


def render_each(template: Column, fields: dict[str, Column]) -> Column:
    """``template.format(...)`` where every row brings its own template.

    Tokens are replaced in one pass, so a value that itself holds ``{name}`` is
    left alone, which a chain of ``replace`` calls would not do.
    """
    tokens = F.regexp_extract_all(template, F.lit(r"(\{\{|\}\}|\{\w+\}|[^{}]+|[{}])"), 1)
    names = {"{{": F.lit("{"), "}}": F.lit("}")} | {"{%s}" % k: v for k, v in fields.items()}
    pairs = [part for name, value in names.items() for part in (F.lit(name), value)]
    values = F.create_map(*pairs)
    return F.array_join(F.transform(tokens, lambda t: F.coalesce(F.try_element_at(values, t), t)), "")
