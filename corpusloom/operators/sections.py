"""Sectioned-text responses (instruction, HTML, JS, CSS) turned into records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import after_first, before_first, strip, title_words
from corpusloom.operators.responses import FENCE, MIN_OUTPUT_CHARS, cut_back, open_fence, strip_reasoning

# Markers, fence languages in their order, default names.
INSTRUCTION, HTML, JS, CSS = (f"=== {name} ===" for name in ("INSTRUCTION", "HTML", "JS", "CSS"))
FENCE_LANGUAGES = ("html", "javascript", "js", "css", "")
DEFAULT_NAME = {"lenient": "MyComponent", "strict": "GraphqlComponent"}


def strip_fences(df: DataFrame, *cols: str) -> DataFrame:
    """Per language: opening fences at any line start, then one closing fence.

    The columns come and stay trimmed, so a closing fence is simply the end of
    the text, and texts without a fence pass through two plain searches.
    """
    for language in FENCE_LANGUAGES:
        opened = {
            c: F.when(
                F.contains(F.col(c), F.lit(FENCE + language)), strip(F.regexp_replace(c, open_fence(language), ""))
            ).otherwise(F.col(c))
            for c in cols
        }
        df = df.withColumns(opened).withColumns({c: cut_back(F.col(c)) for c in cols})
    return df


def split_sections(df: DataFrame, raw: str = "raw", mode: str = "lenient") -> DataFrame:
    """Add ``instruction``, ``html``, ``js``, ``css``; all null when one is missing.

    Sections are found by marker position: linear however long the text is. An
    empty section is a match. ``strict`` also asks for the CSS marker behind JS.
    """
    df = df.withColumn("_text", strip_reasoning(F.col(raw)))
    text = F.col("_text")
    df = df.withColumns(
        {
            "_instruction": after_first(text, INSTRUCTION),
            "_html": after_first(text, HTML),
            "_js": after_first(text, JS),
            "_css": strip(after_first(text, CSS)),
        }
    )
    js_end = before_first(F.col("_js"), CSS)
    df = df.withColumns(
        {
            "_instruction": strip(before_first(F.col("_instruction"), HTML)),
            "_html": strip(before_first(F.col("_html"), JS)),
            "_js": strip(js_end if mode == "strict" else F.coalesce(js_end, F.col("_js"))),
            "_css": F.when(F.upper("_css") == "NONE", "").otherwise(F.coalesce("_css", F.lit(""))),
        }
    )
    found = F.col("_instruction").isNotNull() & F.col("_html").isNotNull() & F.col("_js").isNotNull()
    df = df.withColumns(
        {c: F.when(found, F.col(f"_{c}")) for c in ("instruction", "html", "js", "css")}
    ).drop("_text", "_instruction", "_html", "_js", "_css")
    return strip_fences(df, "html", "js", *(["css"] if mode == "lenient" else []))


def component_name(js: Column, mode: str = "lenient") -> Column:
    """The exported class, else (lenient) the described tag, else a default.

    Blank for a tag without any letter or digit: such a response is no example.
    """
    exported = F.regexp_extract(js, r"(?U)export default class (\w+)", 1)
    names = [F.when(exported != "", exported)]
    if mode == "lenient":
        tag = F.regexp_extract(js, r"(?U)describe\(['\"]c-([\w-]+)", 1)
        titled = F.replace(title_words(F.replace(tag, F.lit("-"), F.lit("_"))), F.lit("_"), F.lit(""))
        names.append(F.when(tag != "", titled))
    return F.coalesce(*names, F.lit(DEFAULT_NAME[mode]))


def file_name(name: Column) -> Column:
    return F.concat(F.lower(F.left(name, F.lit(1))), F.substr(name, F.lit(2)))


def assemble(file: Column, html: Column, js: Column, css: Column) -> Column:
    """All sections in one text, each under its file header."""
    return F.concat(
        F.lit("<!-- "), file, F.lit(".html -->\n"), html,
        F.lit("\n\n// "), file, F.lit(".js\n"), js,
        F.when(css != "", F.concat(F.lit("\n\n/* "), file, F.lit(".css */\n"), css)).otherwise(""),
    )


def section_attempts(df: DataFrame, raw: str = "raw", mode: str = "lenient") -> DataFrame:
    """Add ``example``: instruction, output and name of a response, or null."""
    df = split_sections(df, raw, mode)
    df = df.withColumn("_name", component_name(F.col("js"), mode))
    df = df.withColumn("_file", file_name(F.col("_name")))
    df = df.withColumn("_output", assemble(F.col("_file"), F.col("html"), F.col("js"), F.col("css")))
    example = F.struct(
        F.col("instruction"), F.col("_output").alias("output"), F.col("_name").alias("name"), F.col("_file").alias("file")
    )
    return df.withColumn("example", F.when(F.col("_output").isNotNull() & (F.col("_name") != ""), example)).drop(
        "_name", "_file", "_output", "instruction", "html", "js", "css"
    )


def section_records(df: DataFrame, *keep: str, raw: str = "raw", mode: str = "lenient") -> DataFrame:
    """One row per response that parses; no length gate yet."""
    parsed = section_attempts(df, raw, mode)
    return parsed.select(*keep, F.inline(F.when(F.col("example").isNotNull(), F.array("example"))))


def long_enough(output: Column) -> Column:
    return F.length(output) > MIN_OUTPUT_CHARS
