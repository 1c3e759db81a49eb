"""Record and chat shapes: validation, conversion, coverage, tags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import is_blank

# Documented keys and value lists.
REQUIRED_KEYS = ("instruction", "input", "output", "category", "subcategory", "difficulty", "tags")
CATEGORIES = ("apex", "lwc", "integrations", "architecture")
DIFFICULTIES = ("beginner", "intermediate", "advanced")
ROLES = ("system", "user", "assistant")

# Turns per check window; longer conversations span several.
PART_TURNS = 1024


def with_violations(
    df: DataFrame, categories: tuple[str, ...] = CATEGORIES, difficulties: tuple[str, ...] = DIFFICULTIES
) -> DataFrame:
    """Add ``violations``: one text per broken rule of the example format."""
    rules = [
        F.when(F.col(k).isNull() if k in df.columns else F.lit(True), F.lit(f"missing {k}")) for k in REQUIRED_KEYS
    ]
    for col, allowed in (("category", categories), ("difficulty", difficulties)):
        if col in df.columns:
            rules.append(F.when(~F.col(col).isin(*allowed), F.lit(f"unknown {col}")))
    return df.withColumn("violations", F.array_compact(F.array(*rules)))


def assemble_chat(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """Turns to one ordered message list per conversation: a record holds its conversation whole."""
    rows = F.sort_array(F.collect_list(F.struct(F.col(turn).alias("t"), "role", F.col(text).alias("content"))))
    messages = F.transform(rows, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    return turns.groupBy(conv).agg(messages.alias("messages"))


def check_chat(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """Per conversation: unknown roles, blank turns, late system turns, repeats.

    Neighbours are compared inside parts of PART_TURNS turn numbers, and the
    ends of the parts with each other, so a conversation that holds most turns
    is checked by many tasks.
    """
    part = F.floor(F.col(turn) / PART_TURNS)
    inside = Window.partitionBy(conv, "part").orderBy(turn)
    rows = turns.select(conv, turn, "role", is_blank(F.coalesce(text, F.lit(""))).alias("blank"), part.alias("part"))
    rows = rows.withColumns({
        "before": F.lag("role").over(inside), "opens": F.lag(turn).over(inside).isNull(), "closes": F.lead(turn).over(inside).isNull()
    })

    def total(cond: Column) -> Column:
        return F.sum(F.when(cond, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long")))

    opens, closes = F.col("opens"), F.col("closes")
    parts = rows.groupBy(conv, "part").agg(
        F.count(F.lit(1)).alias("turns"),
        total(~F.coalesce(F.col("role").isin(*ROLES), F.lit(False))).alias("bad_roles"),
        total(F.col("blank")).alias("blank_turns"),
        total((F.col("role") == "system") & ~opens).alias("late_systems"),
        total(F.col("role") == F.col("before")).alias("repeats"),
        F.max(F.when(opens, F.col("role"))).alias("first_role"),
        F.max(F.when(closes, F.col("role"))).alias("last_role"),
    )
    along = Window.partitionBy(conv).orderBy("part")
    parts = parts.withColumns({"last_before": F.lag("last_role").over(along), "later": F.lag("part").over(along).isNotNull()})
    later = F.col("later")
    checks = parts.groupBy(conv).agg(
        F.sum("turns").alias("turns"),
        F.sum("bad_roles").alias("bad_roles"),
        F.sum("blank_turns").alias("blank_turns"),
        (F.sum("late_systems") + total(later & (F.col("first_role") == "system"))).alias("late_systems"),
        (F.sum("repeats") + total(F.col("first_role") == F.col("last_before"))).alias("repeats"),
    )
    faults = reduce(lambda a, b: a + b, [F.col(c) for c in ("bad_roles", "blank_turns", "late_systems", "repeats")])
    return checks.withColumn("ok", faults == 0)


def to_chat(df: DataFrame, system: str | None = None) -> DataFrame:
    """Add ``messages``: optional system, user (instruction and input), assistant."""
    extra = F.when(is_blank(F.coalesce("input", F.lit(""))), F.lit("")).otherwise(F.concat(F.lit("\n\n"), F.col("input")))
    turns = [("system", F.lit(system))] if system else []
    turns += [("user", F.concat(F.col("instruction"), extra)), ("assistant", F.col("output"))]
    return df.withColumn(
        "messages", F.array(*[F.struct(F.lit(role).alias("role"), text.alias("content")) for role, text in turns])
    )


def from_chat(df: DataFrame) -> DataFrame:
    """Single-turn columns from the first user and assistant messages."""
    def first(role: str) -> Column:
        return F.try_element_at(F.filter("messages", lambda m: m["role"] == role), F.lit(1))["content"]

    return df.withColumns(
        {"instruction": first("user"), "input": F.lit(""), "output": first("assistant"), "system": first("system")}
    )


def unify(*frames: DataFrame) -> DataFrame:
    """Prompt/completion and instruction/output records as one table."""
    renamed = [df.withColumnsRenamed({"prompt": "instruction", "completion": "output"}) for df in frames]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), renamed)
    fill = {"input": "", "domain": "Generic"}
    return merged.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in fill.items() if c in merged.columns})


def coverage(records: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows per target category, at zero too, and what is still missing."""
    counts = records.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    n = F.coalesce("n", F.lit(0).cast("long"))
    return targets.join(counts, "category", "left").select(
        "category", "target", n.alias("n"), F.greatest(F.col("target") - n, F.lit(0).cast("long")).alias("missing")
    )


def tag_frequency(df: DataFrame, n: int, tags: str = "tags") -> DataFrame:
    """The ``n`` most frequent tags, ties by name."""
    counts = df.select(F.explode(tags).alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "tag").limit(n)
