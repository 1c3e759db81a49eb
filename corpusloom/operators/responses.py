"""Raw model responses that hold JSON, turned into records.

Input is a table of attempts, one row per response. Each job parses a response
once: intermediate columns are staged, and rows are dropped through a generator,
because a filter over a parsed column would be pushed below it and parse again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import strict_json as J
from corpusloom.functions.text import SPACE_CHARS, WS, is_blank, strip, with_widest_span
from corpusloom.operators.winners import winning_rows

# The fence, gates and attempt limits.
FENCE = "```"
MIN_OUTPUT_CHARS = 200
SECTION_ATTEMPTS = 3
OBJECT_ATTEMPTS = 4
BATCH_ATTEMPTS = 3

SCORES = ("completeness", "alignment", "best_practices", "code_quality")
VERDICT_KEYS = (*SCORES, "verdict", "reason")


def strip_reasoning(raw: Column) -> Column:
    """Remove every closed reasoning block, then trim."""
    return strip(F.regexp_replace(raw, r"(?s)<think>.*?</think>", ""))


def repair_escapes(text: Column, mode: str = "faithful") -> Column:
    """Double a backslash that starts no JSON escape.

    ``faithful`` looks at each backslash alone, so the second half of a correct
    pair may be doubled too, and a digit counts as an escape. ``safe`` skips
    complete pairs and accepts only what JSON accepts.
    """
    if mode == "faithful":
        return F.regexp_replace(text, r'\\(?!["\\/bfnrtu0-9])', r"\\\\")
    if mode == "safe":
        return F.regexp_replace(
            text, r'(?<!\\)((?:\\\\)*+)\\(?!["\\/bfnrt]|u[0-9a-fA-F]{4})', r"$1\\\\"
        )
    raise ValueError(f"unknown mode {mode!r}")


def open_fence(languages: str) -> str:
    """A fence at any line start and the blanks behind it.

    The literal comes first and the line start is looked up behind it, so the
    search runs from fence to fence and not over every line.
    """
    return rf"(?md){FENCE}(?<=^{FENCE}){languages}{WS}*"


def drop_line_end_fences(text: Column) -> Column:
    """Remove every fence at a line end, with the blanks in front of it.

    Cutting at the fences and trimming the pieces is linear; a pattern that
    begins with a run of blanks would be tried from each of them.
    """
    pieces = F.split(text, rf"(?md){FENCE}$", -1)
    return F.array_join(F.transform(pieces, lambda p: F.rtrim(p, F.lit(SPACE_CHARS))), "")


def cut_front(text: Column, fence: str) -> Column:
    """A trimmed text without the fence it starts with."""
    return F.when(F.startswith(text, F.lit(fence)), strip(F.substr(text, F.lit(len(fence) + 1)))).otherwise(text)


def cut_back(text: Column, fence: str = FENCE) -> Column:
    """A trimmed text without the fence it ends with."""
    return F.when(F.endswith(text, F.lit(fence)), strip(F.left(text, F.length(text) - len(fence)))).otherwise(text)


def with_clean_json(df: DataFrame, raw: str, out: str, family: str, escapes: str = "faithful") -> DataFrame:
    """Add ``out``: the JSON text inside a response; the three families differ.

    ``object``: fences at any line; whole text; escapes repaired.
    ``judge``: fences at any line; widest ``{...}``.
    ``batch``: reasoning removed; fences at both ends; widest ``[...]``.
    """
    text = F.col(out)
    if family == "batch":
        # a staged column per step: each looks at the trimmed text more than once
        df = df.withColumn(out, strip_reasoning(F.col(raw)))
        df = df.withColumn(out, cut_front(text, f"{FENCE}json"))
        df = df.withColumn(out, cut_back(text))
        df = df.withColumn(out, cut_front(text, FENCE))
        return with_widest_span(df, out, "[", "]")
    cleaned = drop_line_end_fences(F.regexp_replace(strip(F.col(raw)), open_fence("(?:json)?"), ""))
    if family == "object":
        return df.withColumn(out, repair_escapes(strip(cleaned), escapes))
    return with_widest_span(df.withColumn(out, cleaned), out, "{", "}")


def with_payload(df: DataFrame, raw: str, family: str, out: str, escapes: str = "faithful") -> DataFrame:
    """Add ``out``: the strictly parsed JSON value of a response, or null."""
    return J.with_json(with_clean_json(df, raw, "_text", family, escapes), "_text", out).drop("_text")


def _kinds(e: Column) -> Column:
    """One list element as the kind it is; the other two are null."""
    members, items = J.as_object(e), J.as_list(e)
    return F.struct(members.alias("members"), items.alias("items"), e.alias("value"))


def _parts(k: Column) -> Column:
    """What the rules look at, each taken out of the element once."""
    members, items = k["members"], k["items"]
    word = F.when(members.isNull() & items.isNull(), J.as_string(k["value"]))
    output = F.try_element_at(members, F.lit("output"))
    return F.struct(
        members.alias("members"),
        F.transform(items, J.as_string).alias("words"),
        word.alias("word"),
        (F.map_contains_key(members, "instruction") & F.map_contains_key(members, "output")).alias("has_keys"),
        J.size_of(output).alias("length"),
    )


def _names_both(p: Column) -> Column:
    """A list or text that names both keys looks like a record, but is none."""
    return F.when(
        p["words"].isNotNull(),
        F.coalesce(F.array_contains(p["words"], "instruction") & F.array_contains(p["words"], "output"), F.lit(False)),
    ).when(p["word"].isNotNull(), p["word"].contains("instruction") & p["word"].contains("output"))


def _voids(p: Column) -> Column:
    """Elements that cannot be tested fail the attempt they are in."""
    return F.when(p["members"].isNotNull(), p["has_keys"] & p["length"].isNull()).otherwise(
        F.coalesce(_names_both(p), F.lit(True))
    )


def batch_attempts(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Add ``records``: the valid records of a JSON-list response, with their place in it.

    Null when the attempt fails as a whole: no strict JSON, no list, or one
    element of a kind that cannot be tested. An element that merely lacks keys
    or is too short is left out alone.
    """
    df = with_payload(df, raw, "batch", "_json")
    df = df.withColumn("_elems", F.transform(J.as_list(F.col("_json")), _kinds)).drop("_json")
    df = df.withColumn("_elems", F.transform("_elems", _parts))
    numbered = F.transform("_elems", lambda p, i: F.struct(i.cast("long").alias("pos"), p.alias("p")))
    valid = F.filter(numbered, lambda n: F.coalesce(n["p"]["has_keys"] & (n["p"]["length"] > MIN_OUTPUT_CHARS), F.lit(False)))
    records = F.transform(valid, lambda n: F.struct(n["pos"].alias("pos"), n["p"]["members"].alias("record")))
    return df.withColumn("records", F.when(~F.exists("_elems", _voids), records)).drop("_elems")


def explode_records(df: DataFrame, *keep: str, records: str = "records") -> DataFrame:
    """One row per record: kept columns, pos, the typed texts and the open record.

    Only the open record travels through a shuffle; the texts are taken out here.
    """
    rows = df.select(*keep, F.inline(F.when(F.size(records) > 0, F.col(records))))
    member = {k: J.as_text(F.try_element_at("record", F.lit(k))) for k in ("instruction", "input", "output")}
    member["input"] = F.when(F.map_contains_key("record", "input"), member["input"]).otherwise("")
    return rows.select(*keep, "pos", *[v.alias(k) for k, v in member.items()], "record")


def batch_records(df: DataFrame, *keep: str, raw: str = "raw") -> DataFrame:
    """JSON-list responses to typed records."""
    parsed = batch_attempts(df, raw)
    return explode_records(parsed, *keep).drop("record")


def open_record(record: Column, **overrides: Column) -> Column:
    """The whole record as JSON, extra keys included, with some keys set."""
    if not overrides:
        return F.to_json(record)
    names = F.array(*[F.lit(k) for k in overrides])
    kept = F.map_filter(record, lambda k, _: ~F.array_contains(names, k))
    pairs = [part for k, v in overrides.items() for part in (F.lit(k), v.cast("variant"))]
    return F.to_json(F.map_concat(kept, F.create_map(*pairs)))


def _object_element(e: Column) -> Column:
    members = J.as_object(e)
    output = F.try_element_at(members, F.lit("output"))
    missing = ~F.map_contains_key(members, "output")
    text = F.when(missing, F.lit("")).otherwise(J.as_string(output))
    return F.struct(
        F.when(members.isNull(), F.lit("element is no object"))
        .when(text.isNull(), F.lit("output is no text"))
        .alias("error"),
        F.when(~F.map_contains_key(members, "instruction"), F.lit(""))
        .otherwise(J.as_text(F.try_element_at(members, F.lit("instruction"))))
        .alias("instruction"),
        F.lit("").alias("input"),
        text.alias("output"),
    )


def object_attempts(df: DataFrame, raw: str = "raw", escapes: str = "faithful") -> DataFrame:
    """Add ``elements``: a response as a list, a lone value as a list of one.

    Null when the text is no JSON. An element that would have stopped a run
    carries its ``error`` and is set aside by :func:`quarantined`.
    """
    df = with_payload(df, raw, "object", "_json", escapes)
    listed = F.coalesce(J.as_list(F.col("_json")), F.when(F.col("_json").isNotNull(), F.array("_json")))
    return df.withColumn("elements", F.transform(listed, _object_element)).drop("_json")


def _elements(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*keep, F.posexplode(F.when(F.size("elements") > 0, F.col("elements"))).alias("pos", "e")).select(
        *keep, F.col("pos").cast("long").alias("pos"), "e.*"
    )


def object_records(df: DataFrame, *keep: str) -> DataFrame:
    """Elements with a non-blank output."""
    rows = _elements(df, *keep)
    return rows.where(F.col("error").isNull() & ~is_blank(F.col("output"))).drop("error")


def quarantined(df: DataFrame, *keep: str) -> DataFrame:
    """Elements that cannot be a record, with the reason."""
    return _elements(df, *keep).where(F.col("error").isNotNull()).select(*keep, "pos", "error")


def verdict_attempts(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Add ``verdict``: scores and reason of a judge response, or null.

    All six keys must be there and the scores must be numbers; the range of a
    score is not checked. The judge's own verdict is kept for the record only.
    """
    df = with_payload(df, raw, "judge", "_json").withColumn("_members", J.as_object(F.col("_json")))
    has_keys = F.forall(F.array(*[F.lit(k) for k in VERDICT_KEYS]), lambda k: F.map_contains_key(F.col("_members"), k))
    member = {k: F.try_element_at(F.col("_members"), F.lit(k)) for k in VERDICT_KEYS}
    df = df.withColumn(
        "_scores",
        F.struct(
            *[J.as_number(member[k]).alias(k) for k in SCORES],
            J.as_text(member["verdict"]).alias("judge_verdict"),
            J.as_text(member["reason"]).alias("reason"),
        ),
    ).withColumn("_valid", has_keys)
    numeric = F.col("_valid")
    for k in SCORES:
        numeric = numeric & F.col(f"_scores.{k}").isNotNull()
    return df.withColumn("verdict", F.when(numeric, F.col("_scores"))).drop("_json", "_members", "_scores", "_valid")


def attempt_order(stage: Column, attempt: Column) -> Column:
    """Attempts of a stage before those of the next, as one number."""
    return stage.cast("long") * F.lit(1 << 32) + attempt.cast("long")


def up_to(attempts: DataFrame, most: int | None, attempt: str = "attempt") -> DataFrame:
    """All attempts, or those a run with a limit would have made."""
    return attempts if most is None else attempts.where(F.col(attempt) <= most)


def first_acceptable(
    attempts: DataFrame, keys: list[str], order: Column, value: str, ok: Column, among: DataFrame | None = None
) -> DataFrame:
    """Per key the value of its lowest attempt that passes the gate.

    Failed attempts leave through a generator. The others are written once, the
    lowest of a key is found without its value, and only that value is fetched.
    Keys without a passing attempt are absent and stay "remaining", as are those not in ``among``, if that is given.
    """
    passing = attempts.select(
        *keys, F.inline(F.when(ok, F.array(F.struct(order.cast("long").alias("_attempt"), F.col(value).alias(value)))))
    )
    return winning_rows(passing, keys, F.col("_attempt"), among=among).select(*keys, value)
