"""Repairs, filters and shaping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import fixtures as fx
from corpusloom.catalog.sql import COMPONENT
from corpusloom.operators import cleaning as C


def _rule(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fx.components(spark, sf_dir).select("doc_id", C.RULES[name](F.col("output")).alias("output"))

    return query


def fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.fix_examples(fx.components(spark, sf_dir), changed=True).drop("instruction")


def tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third instruction asks for tests, every second output has one."""
    ask = F.when(F.col("doc_id") % 3 == 0, "Write JEST checks ").otherwise("Build a view ")
    call = F.when(F.col("doc_id") % 2 == 0, "it ('works', f);\n").otherwise("submit('x');\n")
    rows = fx.texts(spark, sf_dir).select(
        "doc_id", F.concat(ask, F.lit("no "), "doc_id").alias("instruction"), F.concat(call, "text").alias("output")
    )
    return C.drop_bad_tests(rows)


def shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    ex = fx.examples(spark, sf_dir).select(
        "instruction", "output", F.concat("category", F.lit(" & Co (a/b)")).alias("category"),
        F.when(F.col("doc_id") % 2 == 0, F.col("type")).alias("domain"),
    )
    return C.shape_sectioned(ex)


def tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    ex = fx.examples(spark, sf_dir).select("doc_id", "output", F.concat(F.lit("CR-"), "doc_id").alias("call_id"))
    return C.tag_by_call(ex, "code_review")


def derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    call = F.concat("source", F.when(F.col("doc_id") % 2 == 0, "-").otherwise(""), F.when(F.col("doc_id") % 3 == 0, "domain-1").otherwise("x"))
    return C.derive_from_call(fx.texts(spark, sf_dir).select("doc_id", call.alias("call_id")))


def union(spark: SparkSession, sf_dir: str) -> DataFrame:
    ex = fx.examples(spark, sf_dir)
    old = ex.join(fx.done(spark, sf_dir), "doc_id", "left_semi").select("doc_id", "output", "category")
    return C.union_results(old, ex.select("doc_id", "output", "type"))


QUERIES = {
    "c1_track": _rule("track"),
    "c2_isloading": _rule("loading"),
    "c3_css": _rule("css"),
    "c4_header": _rule("header"),
    "c5_fix": fixes,
    "c6_jest": tests,
    "c7_shape": shape,
    "c8_tag": tag,
    "c9_derive": derive,
    "c10_union": union,
}

_FIXED_EXTRA = """CASE doc_id % 4 WHEN 2 THEN '<!-- b-c.html -->' || chr(10)
      WHEN 3 THEN '/* a.css */' || chr(10) || ':host {}' || chr(10) ELSE extra END"""

ORACLES = {
    "c1_track": f"WITH {COMPONENT} SELECT doc_id, top || untracked || field || extra || rest AS output FROM comp",
    "c2_isloading": f"""WITH {COMPONENT}
        SELECT doc_id, top || tracked || CASE WHEN doc_id % 4 = 1 THEN '' ELSE field END || extra || rest AS output FROM comp""",
    "c3_css": f"""WITH {COMPONENT}
        SELECT doc_id, top || tracked || field || CASE WHEN doc_id % 4 = 3 THEN {_FIXED_EXTRA} ELSE extra END || rest AS output
        FROM comp""",
    "c4_header": f"""WITH {COMPONENT}
        SELECT doc_id, top || tracked || field || CASE WHEN doc_id % 4 = 2 THEN {_FIXED_EXTRA} ELSE extra END || rest AS output
        FROM comp""",
    "c5_fix": f"""WITH {COMPONENT}
        SELECT doc_id, top || untracked || CASE WHEN doc_id % 4 = 1 THEN '' ELSE field END || {_FIXED_EXTRA} || rest AS output,
               true AS track_changed, doc_id % 4 = 1 AS loading_changed, doc_id % 4 = 3 AS css_changed,
               doc_id % 4 = 2 AS header_changed
        FROM comp""",
    "c6_jest": """
        SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'Write JEST checks ' ELSE 'Build a view ' END || 'no ' || doc_id AS instruction,
               CASE WHEN doc_id % 2 = 0 THEN 'it (''works'', f);' ELSE 'submit(''x'');' END || chr(10) || text AS output
        FROM documents WHERE doc_id % 3 <> 0 OR doc_id % 2 = 0""",
    "c7_shape": """
        SELECT split_part(text, chr(10), 1) AS prompt, text AS completion, '' AS input,
               'synthetic_lwc_master/' || lower(source) || '_&_co_a_b' AS source, 'lwc' AS type,
               source || ' & Co (a/b)' AS category, CASE WHEN doc_id % 2 = 0 THEN lang ELSE 'Generic' END AS domain
        FROM documents""",
    "c8_tag": """
        SELECT doc_id, text AS output, 'CR-' || doc_id AS call_id, 'CR-' || doc_id AS category, 'code_review' AS type
        FROM documents""",
    "c9_derive": """
        SELECT doc_id, source || CASE WHEN doc_id % 2 = 0 THEN '-' ELSE '' END || CASE WHEN doc_id % 3 = 0 THEN 'domain-1' ELSE 'x' END AS call_id,
               source || CASE WHEN doc_id % 2 = 0 THEN '' WHEN doc_id % 3 = 0 THEN 'domain' ELSE 'x' END AS category,
               CASE WHEN doc_id % 3 = 0 THEN 'domain' ELSE 'generic' END AS type
        FROM documents""",
    "c10_union": """
        SELECT doc_id, text AS output, source AS category, NULL AS type FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
        UNION ALL SELECT doc_id, text, NULL, lang FROM documents""",
}
