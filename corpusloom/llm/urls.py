"""Operator 13: url filters by a tree of path templates per host.

Built-in functions only. A url that a rule fits is judged by the longest such rule;
these urls are also the labelled ones that the rest is judged by.

A path is cut into segments. What is variable by its looks is generalised at
once: a long hexadecimal segment becomes ``{x}``, every run of digits ``{n}``. Urls of
equal host and generalised path are counted together, so the tree is grown over
shapes, not over urls. Below each host it grows level by level:

- A segment seen on fewer than MIN_PAGES pages of its node, or on less than
  MIN_SHARE of them, is variable too and becomes ``*``.
- The other branches, at most 1 / MIN_SHARE of a node, are merged from the largest
  down: each joins the largest cluster it does not differ from in the shares of what
  comes next in its paths and of blocked, allowed and unlabelled pages, by Hoeffding's bound.
- A node's purity is (blocked + STRENGTH * purity of its parent) / (labelled + STRENGTH),
  PRIOR at the host: a branch with few labels leans on those above it. The host's own
  labels are no prior: a branch that none of its siblings resembles starts afresh.
- A node with fewer than MIN_PAGES pages or with one shape is not split any further:
  ``**`` stands for the rest of its paths.

A url is blocked if the purity of its template is REJECT or more.

Defined results. A null url, or one without ``://``, has an empty host and path, fits no
rule and is judged by the template of empty paths of the empty host. Repeated rows are
judged, and counted, one by one. A host beyond all labels has purity PRIOR: allowed. Of
rules of equal length the one with the longer host wins, then block. Other columns,
whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.skew import lookup_join
from corpusloom.session import stage, work_dir

ALLOW, BLOCK = "allow", "block"
# (verdict, host, path)
RULES = (
    (ALLOW, "com", "/"), (BLOCK, "example.com", "/en/"), (ALLOW, "www.example.com", "/en/"), (BLOCK, "net", "/es/"), (BLOCK, "net", "/fr/"),
)
MIN_PAGES, MIN_SHARE = 4, 0.02
# Two branches count as alike if their shares differ by less than chance would make them in all but this part of cases.
ALPHA = 0.05
STRENGTH, PRIOR, REJECT = 4.0, 0.5, 0.8

# What may come next below a branch, and how a page is labelled.
NEXT = ("end", "number", "mixed", "word")
LABELS = ("blocked", "allowed", "unlabelled")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) of every page."""
    spark = pages.sparkSession
    parsed = _parsed(pages, rules)
    shapes = parsed.groupBy("key").agg(
        F.first("host").alias("host"), F.first("segments").alias("segments"), F.count(F.lit(1)).alias("pages"),
        *[F.sum((F.coalesce("verdict", F.lit("")) == v).cast("long")).alias(n) for v, n in ((BLOCK, "blocked"), (ALLOW, "allowed"))],
    )
    templates = grown(stage(shapes, work_dir(spark, "url-shapes")))
    judged = lookup_join(parsed.drop("segments"), templates.select("key", "template", "purity"), "key", "left")
    own = F.when(F.col("purity") >= REJECT, BLOCK).otherwise(ALLOW)
    return judged.select("page_id", "host", "path", "rule", F.coalesce("verdict", own).alias("verdict"), "template", "purity")


def with_host_and_path(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` and ``path``."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")
    pages = pages.withColumn("_rest", F.regexp_extract(rest, r"^[^?#]*", 0))
    host = F.regexp_extract("_rest", r"^[^/]*", 0)
    return pages.select(
        *[c for c in pages.columns if c not in ("_rest", url, "host", "path")],
        F.translate(host, UPPER, LOWER).alias("host"), F.substring(F.col("_rest"), F.length(host) + 1, F.length("_rest")).alias("path"),
    )


def ruled(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """(length, host length, blocks, rule, verdict) of the rule that wins, or null."""
    def entry(verdict: str, h: str, p: str) -> Column:
        fits = ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p))
        return F.when(fits, F.struct(
            F.lit(len(h) + len(p)).alias("length"), F.lit(len(h)).alias("host_length"), F.lit(verdict == BLOCK).alias("blocks"),
            F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"),
        ))

    none = F.lit(None).cast("struct<length:int,host_length:int,blocks:boolean,rule:string,verdict:string>")
    return F.array_max(F.array(*[entry(*r) for r in rules])) if rules else none


def generalised(segment: Column) -> Column:
    """A segment without what looks variable."""
    hexadecimal = segment.rlike(r"^[0-9a-fA-F-]{16,}$") & segment.rlike("[0-9]")
    return F.when(hexadecimal, "{x}").otherwise(F.regexp_replace(segment, "[0-9]+", "{n}"))


def _parsed(pages: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(page_id, host, path, rule, verdict, segments, key): ``key`` names host and generalised path."""
    rows = with_host_and_path(pages.select("page_id", "url"))
    rows = rows.withColumn("_won", ruled(F.col("host"), F.col("path"), rules))
    # the text before the first slash is empty
    segments = F.slice(F.transform(F.split("path", "/", -1), generalised), 2, F.greatest(F.lit(1), F.length("path")))
    rows = rows.select("page_id", "host", "path", "_won.rule", "_won.verdict", segments.alias("segments"))
    return rows.withColumn("key", F.concat_ws("/", F.array("host"), "segments"))


def grown(shapes: DataFrame) -> DataFrame:
    """(key, template, purity) of every shape: the trees of all hosts, a level a round.

    ``shapes``: key, host, segments, pages, blocked, allowed. A round reads the shapes
    whose node is still to be split and writes those of the next level.
    """
    spark = shapes.sparkSession
    counts = ("pages", "blocked", "allowed")
    state = shapes.select("key", F.col("host").alias("node"), F.col("segments").alias("rest"), *counts, F.lit(PRIOR).alias("purity"))
    done = []
    while True:
        nodes = state.groupBy("node").agg(F.sum("pages").alias("node_pages"), F.count(F.lit(1)).alias("node_shapes"))
        split = (F.col("node_pages") >= MIN_PAGES) & (F.col("node_shapes") > 1) & (F.size("rest") > 0)
        state = state.join(stage(nodes, work_dir(spark, "url-nodes")), "node").withColumn("open", split)
        state = stage(state, work_dir(spark, "url-level"), "open")
        rest = F.when(F.size("rest") == 0, "").when(F.col("node_shapes") == 1, F.concat(F.lit("/"), F.concat_ws("/", "rest"))).otherwise("/**")
        done.append(state.where(~F.col("open")).select("key", F.concat("node", rest).alias("template"), "purity"))
        state = state.where("open")
        if state.isEmpty():
            break
        state = _next_level(state, counts)
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


def _next_level(state: DataFrame, counts: Sequence[str]) -> DataFrame:
    spark = state.sparkSession
    state = state.withColumn("token", F.element_at("rest", 1)).withColumn("next", _kind(F.get("rest", F.lit(1))))
    shares = [
        *[F.sum(F.when(F.col("next") == k, F.col("pages")).otherwise(0)).cast("double") for k in NEXT],
        F.sum("blocked").cast("double"), F.sum("allowed").cast("double"),
        F.sum(F.col("pages") - F.col("blocked") - F.col("allowed")).cast("double"),
    ]
    tokens = state.groupBy("node", "token").agg(
        F.first("node_pages").alias("node_pages"), F.sum("pages").alias("pages"), F.array(*shares).alias("v")
    )
    kept = tokens.where((F.col("pages") >= MIN_PAGES) & (F.col("pages") >= MIN_SHARE * F.col("node_pages")))
    # at most 1 / MIN_SHARE branches of a node; of equal size in order of their names
    branch = F.struct((-F.col("pages")).alias("order"), F.col("token"), F.col("pages").cast("double").alias("n"), F.col("v"))
    clusters = kept.groupBy("node").agg(F.sort_array(F.collect_list(branch)).alias("branches"))
    clusters = clusters.select("node", F.explode(_clustered(F.col("branches"))).alias("c"))
    names = clusters.select("node", F.explode("c.tokens").alias("token"), F.array_join(F.array_sort("c.tokens"), "|").alias("branch"))
    names = stage(names.withColumn("branch", F.when(F.contains("branch", F.lit("|")), F.concat(F.lit("("), "branch", F.lit(")"))).otherwise(F.col("branch"))), work_dir(spark, "url-branches"))
    state = state.join(names, ["node", "token"], "left").select(
        "key", F.concat("node", F.lit("/"), F.coalesce("branch", F.lit("*"))).alias("node"),
        F.slice("rest", 2, F.size("rest")).alias("rest"), *counts, "purity",
    )
    state = stage(state, work_dir(spark, "url-level"))
    below = state.groupBy("node").agg(F.sum("blocked").alias("b"), F.sum("allowed").alias("a"))
    purity = (F.col("b") + STRENGTH * F.col("purity")) / (F.col("b") + F.col("a") + STRENGTH)
    return state.join(stage(below, work_dir(spark, "url-nodes")), "node").withColumn("purity", purity).drop("a", "b")


def _kind(segment: Column) -> Column:
    """What a generalised segment is: one of NEXT."""
    return (
        F.when(segment.isNull(), NEXT[0]).when(segment.isin("{n}", "{x}"), NEXT[1])
        .when(F.contains(segment, F.lit("{n}")), NEXT[2]).otherwise(NEXT[3])
    )


def _clustered(branches: Column) -> Column:
    """Clusters (tokens, n, v) of the branches of a node, given from the largest down."""
    def alike(c: Column, b: Column) -> Column:
        chance = F.sqrt(F.lit(0.5) * F.log(F.lit(2.0 / ALPHA))) * (1 / F.sqrt(c["n"]) + 1 / F.sqrt(b["n"]))
        return F.forall(F.zip_with(c["v"], b["v"], lambda x, y: F.abs(x / c["n"] - y / b["n"]) <= chance), lambda fits: fits)

    def joined(clusters: Column, b: Column) -> Column:
        place = F.array_position(F.transform(clusters, lambda c: alike(c, b)), True)
        alone = F.struct(F.array(b["token"]).alias("tokens"), b["n"].alias("n"), b["v"].alias("v"))

        def with_branch(c: Column, i: Column) -> Column:
            both = F.struct(
                F.concat(c["tokens"], F.array(b["token"])).alias("tokens"), (c["n"] + b["n"]).alias("n"),
                F.zip_with(c["v"], b["v"], lambda x, y: x + y).alias("v"),
            )
            return F.when(i == place - 1, both).otherwise(c)

        return F.when(place == 0, F.concat(clusters, F.array(alone))).otherwise(F.transform(clusters, with_branch))

    none = F.array().cast("array<struct<tokens:array<string>,n:double,v:array<double>>>")
    return F.aggregate(branches, none, joined)
