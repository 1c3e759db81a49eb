"""Record and chat shapes, coverage, tags, policies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import fixtures as fx
from corpusloom.operators import formats, lint


def validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories by length, one difficulty in three wrong, tags missing at times."""
    d = F.col("doc_id")
    rows = fx.examples(spark, sf_dir).select(
        "doc_id", "instruction", "input", "output",
        F.when(d % 2 == 0, "apex").otherwise(F.col("category")).alias("category"),
        F.lit("forms").alias("subcategory"),
        F.when(d % 3 == 0, "expert").otherwise("beginner").alias("difficulty"),
        F.when(d % 5 != 0, F.array("type")).alias("tags"),
    )
    checked = formats.with_violations(rows)
    return checked.select("doc_id", F.size("violations").cast("long").alias("n"), F.array_join("violations", "; ").alias("violations"))


def _line(messages: Column) -> Column:
    return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n")


def chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = formats.assemble_chat(fx.table(spark, sf_dir, "conversations"))
    return rows.select("conv_id", F.size("messages").cast("long").alias("n"), _line(F.col("messages")).alias("chat"))


def chat_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some turns get an unknown role, none at all, a blank text or the system role."""
    turns = fx.table(spark, sf_dir, "conversations")
    mark = (F.col("conv_id") * 5 + F.col("turn") * 3) % 11
    role = F.when(mark == 1, "tool").when(mark == 2, "system").when(mark != 4, F.col("role"))
    text = F.when(mark == 3, " \n").otherwise(F.col("text"))
    return formats.check_chat(turns.select("conv_id", "turn", role.alias("role"), text.alias("text")))


def convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    ex = fx.examples(spark, sf_dir).withColumn("input", F.when(F.col("doc_id") % 2 == 0, F.col("type")).otherwise(" "))
    there = formats.to_chat(ex, system="Be exact.").select("doc_id", "messages")
    back = formats.from_chat(there)
    return back.select("doc_id", F.size("messages").cast("long").alias("n"), "system", "instruction", "input", "output")


def unify(spark: SparkSession, sf_dir: str) -> DataFrame:
    ex = fx.examples(spark, sf_dir)
    one = ex.where("doc_id % 2 = 0").select(
        F.col("instruction").alias("prompt"), F.col("output").alias("completion"), "category", F.col("type").alias("domain")
    )
    return formats.unify(one, ex.where("doc_id % 2 = 1").select("instruction", "input", "output", "category"))


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets: every source plus one per language that has no records."""
    docs = fx.texts(spark, sf_dir)
    targets = docs.select(F.explode(F.array("source", F.concat(F.lit("lang "), "lang"))).alias("category")).distinct()
    return formats.coverage(fx.examples(spark, sf_dir), targets.withColumn("target", F.lit(60).cast("long")))


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.texts(spark, sf_dir)
    words = F.array_distinct(F.split(F.lower("text"), " "))
    return formats.tag_frequency(docs.select(words.alias("tags")), 25)


def policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lint.lint(fx.lint_texts(spark, sf_dir), "doc_id")


def policy_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over whole pages, which bring their own markup."""
    return lint.lint_counts(lint.lint(fx.texts(spark, sf_dir, "pages"), "page_id", text="html"))


QUERIES = {
    "f1_validate": validate,
    "f2_chat": chat,
    "f3_chat_check": chat_check,
    "f4_convert": convert,
    "f5_unify": unify,
    "f6_coverage": coverage,
    "f7_tags": tags,
    "f8_lint": policies,
    "f8_lint_counts": policy_counts,
}

_CASES = """VALUES ('placeholder', [0]), ('missing_sharing', [1]), ('no_security', [3]), ('hardcoded_id', [5]),
                 ('trivial_assert', [6]), ('deprecated_if', [7]), ('inline_style', [8])"""


_POLICIES = """
        SELECT 'placeholder' AS rule, regexp_matches(html, '(?i)//\\s*(?:todo|implement|add logic here)') AS hit FROM pages
        UNION ALL SELECT 'missing_sharing', regexp_matches(html, '\\bclass\\s+\\w+')
          AND NOT regexp_matches(html, '(?i)\\b(?:with|without|inherited)\\s+sharing\\b') FROM pages
        UNION ALL SELECT 'no_security', regexp_matches(html, '(?i)\\[\\s*select\\s')
          AND NOT regexp_matches(html, '(?i)\\bwith\\s+security_enforced\\b') FROM pages
        UNION ALL SELECT 'hardcoded_id',
          regexp_matches(html, '''(?:001|003|005|006|500|a0[0-9A-Za-z])[0-9A-Za-z]{12}(?:[0-9A-Za-z]{3})?''') FROM pages
        UNION ALL SELECT 'trivial_assert', regexp_matches(html, '(?i)\\bSystem\\.assert\\s*\\(\\s*true\\s*\\)') FROM pages
        UNION ALL SELECT 'deprecated_if', regexp_matches(html, '\\bif:(?:true|false)\\s*=') FROM pages
        UNION ALL SELECT 'inline_style', regexp_matches(html, '\\sstyle\\s*=\\s*["'']') FROM pages"""

ORACLES = {
    "f1_validate": """
        SELECT doc_id, len(v) AS n, array_to_string(v, '; ') AS violations
        FROM (SELECT doc_id, list_filter([
                CASE WHEN doc_id % 5 = 0 THEN 'missing tags' END,
                CASE WHEN doc_id % 2 <> 0 AND source NOT IN ('apex', 'lwc', 'integrations', 'architecture') THEN 'unknown category' END,
                CASE WHEN doc_id % 3 = 0 THEN 'unknown difficulty' END], lambda x: x IS NOT NULL) AS v
              FROM documents)""",
    "f2_chat": """
        SELECT conv_id, count(*) AS n, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS chat
        FROM conversations GROUP BY 1""",
    "f3_chat_check": """
        WITH t AS (
          SELECT conv_id, turn, CASE m WHEN 1 THEN 'tool' WHEN 2 THEN 'system' WHEN 4 THEN NULL ELSE role END AS role, m = 3 AS blank
          FROM (SELECT *, (conv_id * 5 + turn * 3) % 11 AS m FROM conversations)),
        l AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS before,
                     row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM t),
        c AS (
          SELECT conv_id, count(*) AS turns, count(*) FILTER (role IS NULL OR role = 'tool') AS bad_roles, count(*) FILTER (blank) AS blank_turns,
                 count(*) FILTER (role = 'system' AND k > 1) AS late_systems, count(*) FILTER (role = before) AS repeats
          FROM l GROUP BY 1)
        SELECT *, bad_roles + blank_turns + late_systems + repeats = 0 AS ok FROM c""",
    "f4_convert": """
        SELECT doc_id, 3::BIGINT AS n, 'Be exact.' AS system,
               split_part(text, chr(10), 1) || CASE WHEN doc_id % 2 = 0 THEN chr(10) || chr(10) || lang ELSE '' END AS instruction,
               '' AS input, text AS output
        FROM documents""",
    "f5_unify": """
        SELECT split_part(text, chr(10), 1) AS instruction, text AS output, source AS category,
               CASE WHEN doc_id % 2 = 0 THEN lang ELSE 'Generic' END AS domain, '' AS input
        FROM documents""",
    "f6_coverage": """
        WITH t AS (SELECT source AS category FROM documents UNION SELECT 'lang ' || lang FROM documents)
        SELECT t.category, 60::BIGINT AS target, count(d.doc_id) AS n, greatest(60 - count(d.doc_id), 0) AS missing
        FROM t LEFT JOIN documents d ON d.source = t.category GROUP BY 1""",
    "f7_tags": """
        SELECT tag, count(*) AS n
        FROM (SELECT unnest(list_distinct(string_split(lower(text), ' '))) AS tag FROM documents)
        GROUP BY 1 ORDER BY n DESC, tag LIMIT 25""",
    "f8_lint": f"""
        WITH cases(rule, ks) AS ({_CASES})
        SELECT doc_id, rule, list_contains(ks, doc_id % 9) AS hit FROM documents, cases""",
    "f8_lint_counts": f"SELECT rule, count(*) AS n, count(*) FILTER (hit) AS hits FROM ({_POLICIES}) GROUP BY 1",
}
