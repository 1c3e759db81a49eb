"""Operator 1: personal data by weak supervision, on built-in expressions only.

Base kinds (email, ip, card, phone) are found by their patterns and always stay.
Further candidates (secrets, local phone numbers, social security numbers,
other long numbers, names) are only proposed by patterns. Labelers of three
sorts vote on each: regex (its shape), gazetteer (a known word in or before it)
and context (what stands around it); a labeler may abstain. Expectation-
maximisation on the counted vote patterns estimates how reliable each labeler
is and how likely each pattern means personal data. With these soft labels a
logistic classifier over span features is trained; it decides which candidates
become spans.

What is counted and fitted on the driver is one row per combination of votes and
features, MAX_PATTERNS at most by construction and however large the corpus is.

A null or empty text has no spans. Rows are kept as they are, repeated or with a
null id. Places are code points, ends exclusive; spans of a place go by kind.
"""

from __future__ import annotations

from math import exp, log, prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import stage, work_dir

# The base kinds as they are listed, then the kinds that are voted on.
BASE = ("email", "ip", "card", "phone")
VOTED = ("secret", "local_phone", "ssn", "number", "name")
KINDS = (*BASE, *VOTED)

# First names and titles that names begin with.
NAMES = (
    "James", "Mary", "Robert", "Patricia", "John", "Jennifer", "Michael", "Linda", "David", "Elizabeth", "William",
    "Barbara", "Richard", "Susan", "Joseph", "Jessica", "Thomas", "Sarah", "Charles", "Karen", "Peter", "Anna", "Hans",
    "Sophie", "Pierre", "Marie", "Juan", "Carmen", "Jose", "Lucia",
)
TITLES = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Monsieur", "Madame")

# The same places as the plain patterns find: a match begins where a run of its
# first class begins or the last match ended, so no run is tried twice.
_LOCAL = "[A-Za-z0-9._%+-]"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9_@.-])(?=[A-Za-z_]*+[0-9])(?=[0-9_]*+[A-Za-z])[A-Za-z0-9_]{20,}+(?!@)",
    "local_phone": r"(?<![0-9+.(-])(?<!\+[0-9]{1,3}[ -])\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}(?![0-9-])",
    "ssn": r"(?<![0-9+-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "name": rf"(?<![A-Za-z])(?=[A-Z])(?:(?:{'|'.join(TITLES)})\.? (?:[A-Z][a-z]++ )?|(?:{'|'.join(NAMES)}) )[A-Z][a-z]++",
}
# Words that announce each voted kind.
ANNOUNCED = {
    "secret": "token|secret|api.?key|password|passwd|credential|bearer",
    "local_phone": "phone|tel|call|mobile|fax|cell",
    "ssn": "ssn|social|security|taxpayer",
    "number": "card|account|iban|visa|passport|number",
    "name": "name|dear|sincerely|contact|author|patient",
}
SHAPES = {
    "secret": "^(?:[0-9a-f]{32,}|[0-9A-F]{32,}|[A-Za-z0-9_]{24,})$",
    "local_phone": r"^\([0-9]{3}\) [0-9]{3}-[0-9]{4}$",
    "ssn": "^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
    "number": "^[3-6][0-9]{3}([ -]?[0-9]{4}){3}$",
    "name": "^(?:[A-Z][a-z]+\\.? )+[A-Z][a-z]{2,}$",
}
# Buckets of each feature, 0 to n - 1; votes are -1 (abstain), 0 (against), 1 (for).
FEATURES = {"kind": len(VOTED), "length": 4, "assigned": 2, "quoted": 2, "announced": 2, "varied": 3}
LABELERS = ("shape", "gazetteer", "assignment", "variety", "edges")
MAX_PATTERNS = 3 ** len(LABELERS) * prod(FEATURES.values())
ACCEPTED = 0.5
_BLOCK = 256


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, also where a nested lambda uses it for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(part: Column) -> Column:
    return F.aggregate(part, F.lit(0), lambda a, b: a + b)


def _starts(sizes: Column) -> Column:
    """Sums of all earlier entries; entries are summed in blocks, so that long arrays stay cheap."""

    def before(z: Column) -> Column:
        n_blocks = F.greatest(F.ceil(F.size(z) / _BLOCK).cast("int"), F.lit(1))
        blocks = F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda b: _total(F.slice(z, b * _BLOCK + 1, F.lit(_BLOCK))))
        return F.aggregate(blocks, F.array(F.lit(0)), lambda a, b: F.concat(a, F.array(F.element_at(a, -1) + b)))

    def start(z: Column, sums: Column, i: Column) -> Column:
        block = F.floor(i / _BLOCK).cast("int")
        return F.get(sums, block) + _total(F.slice(z, block * _BLOCK + 1, i - block * _BLOCK))

    return _let(sizes, lambda z: _let(before(z), lambda sums: F.transform(z, lambda _, i: start(z, sums, i))))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(text: Column) -> Column:
    def total(back: Column) -> Column:
        def add(sofar: Column, i: Column) -> Column:
            d = F.substring(back, i, F.lit(1)).cast("int")
            return sofar + F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

        return F.aggregate(F.sequence(F.lit(1), F.length(back)), F.lit(0), add)

    return _let(F.reverse(_digits(text)), total) % 10 == 0


def _between(n: Column, low: int, high: int) -> Column:
    return (n >= low) & (n <= high)


def _is_card(text: Column) -> Column:
    return F.when(_between(F.length(_digits(text)), 12, 19), _luhn(text)).otherwise(False)


VALID = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(rf"^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$"),
    "card": _is_card,
    "phone": lambda m: _between(F.length(_digits(m)), 9, 15),
}


def found(docs: DataFrame, *keep: str) -> DataFrame:
    """(doc_id, *keep, base, candidates): base spans (start, kind, finish) and candidates with their votes and features.

    One evaluation of each pattern per text; most texts are spared most patterns
    by one look for an at sign and one for a digit.
    """
    ids = ("doc_id", *keep)
    rows = docs.select(*ids, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("*", F.contains("text", F.lit("@")).alias("at"), F.col("text").rlike("[0-9]").alias("digit"))
    worth = {k: F.col("at") if k == "email" else F.lit(True) if k == "name" else F.col("digit") for k in PATTERNS}
    none = F.array().cast("array<string>")
    rows = rows.select(*ids, *(
        F.when(worth[k], F.struct(
            F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias("is"), F.split("text", p, -1).alias("between")
        )).otherwise(F.struct(none.alias("is"), none.alias("between"))).alias(k)
        for k, p in PATTERNS.items()
    ))
    rows = rows.select(*ids, *(
        F.when(F.size(F.col(k)["is"]) > 0, F.struct(F.col(k)["is"].alias("is"), F.col(k)["between"].alias("between"), _starts(
            F.zip_with(F.col(k)["between"], F.col(k)["is"], lambda g, m: F.length(g) + F.coalesce(F.length(m), F.lit(0)))
        ).alias("at"))).alias(k)
        for k in PATTERNS
    ))

    def spans(k: str) -> Column:
        """(start, finish, text, before, behind) of every match of a pattern."""
        return F.transform(F.col(k)["is"], lambda m, i: F.struct(
            (F.get(F.col(k)["at"], i) + F.length(F.get(F.col(k)["between"], i))).alias("start"), m.alias("text"),
            F.right(F.get(F.col(k)["between"], i), F.lit(30)).alias("before"),
            F.left(F.get(F.col(k)["between"], i + 1), F.lit(2)).alias("behind"),
        ))

    rows = rows.select(*ids, *(spans(k).alias(k) for k in PATTERNS))
    base, voted = [], []
    for k in BASE:
        base.append(_or_none(_base_spans(k), "array<struct<start:int,kind:int,finish:int>>"))
    votes = "array<struct<start:int,kind:int,finish:int,votes:array<int>,features:array<int>>>"
    for k in VOTED:
        mine = F.col(k)
        if k == "number":  # card-like, but for the check digit
            mine = F.filter(F.col("card"), lambda s: _between(F.length(_digits(s.text)), 13, 19) & ~_luhn(s.text) & ~s.before.endswith("+"))
        voted.append(_or_none(_judged_spans(mine, k), votes))
    return rows.select(*ids, F.array_sort(F.flatten(F.array(*base))).alias("base"), F.flatten(F.array(*voted)).alias("candidates"))


def _or_none(spans: Column, kind: str) -> Column:
    return F.coalesce(spans.cast(kind), F.array().cast(kind))


def _base_spans(kind: str) -> Column:
    return F.transform(F.filter(kind, lambda s: VALID[kind](s.text)), lambda s: _span(s, kind))


def _judged_spans(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: _judged(s, kind))


def _span(s: Column, kind: str) -> Column:
    return F.struct(s.start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (s.start + F.length(s.text)).alias("finish"))


def _judged(s: Column, kind: str) -> Column:
    """A candidate with the labelers' votes and its features, in the order of LABELERS and FEATURES."""
    assigned = s.before.rlike("[=:][ \t]*[\"']?$")
    quoted = s.before.rlike("[\"']$") & s.behind.rlike("^[\"']")
    announced = F.lower(s.before).rlike(ANNOUNCED[kind])
    known = s.text.rlike(rf"^(?:{'|'.join(NAMES)}) ") if kind == "name" else announced
    variety = F.size(F.array_distinct(F.split(F.lower(s.text), "")))
    varied = F.when(variety < 5, 0).when(variety < 10, 1).otherwise(2)
    glued = s.before.rlike("[A-Za-z0-9]$") | s.behind.rlike("^[A-Za-z0-9]")
    length = F.length(s.text)
    votes = F.array(
        s.text.rlike(SHAPES[kind]).cast("int"),
        F.when(known, 1).otherwise(-1),
        F.when(assigned, 1).otherwise(-1),
        F.when(varied == 0, 0).when(varied == 2, 1).otherwise(-1),
        F.when(glued, 0).otherwise(-1),
    )
    features = F.array(
        F.lit(VOTED.index(kind)), F.when(length < 12, 0).when(length < 20, 1).when(length < 36, 2).otherwise(3),
        assigned.cast("int"), quoted.cast("int"), announced.cast("int"), varied,
    )
    return F.struct(
        s.start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (s.start + length).alias("finish"),
        votes.alias("votes"), features.alias("features"),
    )


def reliabilities(counts: dict[tuple[int, ...], int], rounds: int = 30) -> tuple[float, list[dict[int, tuple[float, float]]], dict]:
    """Prior, each labeler's chance of each vote (on no data, on data) and the posterior of every vote pattern.

    Expectation-maximisation for conditionally independent labelers, for whom
    abstaining is a third vote, begun at the share of votes for among votes cast;
    counts are smoothed by one.
    """
    cast = {p: [v for v in p if v >= 0] for p in counts}
    belief = {p: min(0.95, max(0.05, (sum(v) + 0.5) / (len(v) + 1))) for p, v in cast.items()}
    prior, chances = 0.5, []
    for _ in range(rounds):
        yes = sum(n * belief[p] for p, n in counts.items())
        total = sum(counts.values())
        prior = (yes + 1) / (total + 2)
        chances = []
        for k in range(len(LABELERS)):
            chances.append({
                v: (
                    (sum(n * (1 - belief[p]) for p, n in counts.items() if p[k] == v) + 1) / (total - yes + 3),
                    (sum(n * belief[p] for p, n in counts.items() if p[k] == v) + 1) / (yes + 3),
                )
                for v in (-1, 0, 1)
            })
        for p in counts:
            odds = log(prior / (1 - prior)) + sum(log(c[v][1] / c[v][0]) for c, v in zip(chances, p))
            belief[p] = 1 / (1 + exp(-max(-30.0, min(30.0, odds))))
    return prior, chances, belief


def train(counts: dict[tuple[tuple[int, ...], tuple[int, ...]], int], rounds: int = 200) -> list[list[float]]:
    """Weights of the span classifier by feature and bucket, fitted to the soft labels of the votes."""
    by_votes: dict[tuple[int, ...], int] = {}
    for (votes, _), n in counts.items():
        by_votes[votes] = by_votes.get(votes, 0) + n
    belief = reliabilities(by_votes)[2]
    rows: dict[tuple[int, ...], list[float]] = {}
    for (votes, features), n in counts.items():
        row = rows.setdefault(features, [0.0, 0.0])
        row[0] += n
        row[1] += n * belief[votes]
    weights, total = [[0.0] * n for n in FEATURES.values()], sum(r[0] for r in rows.values()) or 1.0
    for _ in range(rounds):
        slope = [[0.0] * n for n in FEATURES.values()]
        for features, (n, yes) in rows.items():
            p = 1 / (1 + exp(-sum(w[f] for w, f in zip(weights, features))))
            for g, f in zip(slope, features):
                g[f] += (yes - n * p) / total
        for w, g in zip(weights, slope):
            for f in range(len(w)):
                w[f] += 2.0 * g[f] - 1e-3 * w[f]
    return weights


def fitted(rows: DataFrame) -> list[list[float]]:
    """Classifier weights from the candidates of ``found`` rows."""
    one = rows.select(F.explode("candidates").alias("c"))
    counted = one.groupBy("c.votes", "c.features").agg(F.count(F.lit(1)).alias("n")).collect()
    return train({(tuple(r["votes"]), tuple(r["features"])): r["n"] for r in counted})


def decided(weights: list[list[float]]) -> Column:
    """All spans of a ``found`` row in order: base spans and accepted candidates."""

    def margin(c: Column) -> Column:
        terms = [F.get(F.array(*map(F.lit, w)), F.get(c.features, F.lit(k))) for k, w in enumerate(weights)]
        return sum(terms[1:], terms[0])

    accepted = F.filter("candidates", lambda c: margin(c) >= log(ACCEPTED / (1 - ACCEPTED)))
    added = F.transform(accepted, lambda c: F.struct(c.start.alias("start"), c.kind.alias("kind"), c.finish.alias("finish")))
    return F.array_sort(F.concat("base", added))


def written(spans_column: str) -> Column:
    """kind:start:end of every span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans_column, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start, s.finish)))


def _number(kind: int) -> Column:
    return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: counts and digest of the base spans, and all spans."""
    rows = stage(found(docs), work_dir(docs.sparkSession, "pii"))
    rows = rows.select("doc_id", "base", decided(fitted(rows)).alias("spans"))
    numbers = [_number(k).alias(f"n_{name}") for k, name in enumerate(BASE)]
    return rows.select("doc_id", *numbers, F.sha2(written("base"), 256).alias("base_sha256"), written("spans").alias("spans"))


def masked(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; all rows and other columns stay as they are.

    Overlapping spans are replaced as one, named by the first. The texts are
    looked at twice, once to fit and once to mask, and never shuffled.
    """
    weights = fitted(stage(found(docs).select("candidates"), work_dir(docs.sparkSession, "pii")))
    rows = found(docs.withColumn("_llm_all", F.struct(*docs.columns)), "_llm_all").withColumn("_llm_spans", decided(weights))
    text, names = F.col("_llm_all")["text"], F.array(*(F.lit(f"[{k}]") for k in KINDS))
    begin = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("at"))

    def cut(done: Column, s: Column) -> Column:
        kept = F.substring(text, done.at + 1, F.greatest(s.start - done.at, F.lit(0)))
        name = F.when(s.start >= done.at, F.get(names, s.kind)).otherwise("")
        return F.struct(F.concat(done.out, F.array(kept, name)).alias("out"), F.greatest(done.at, s.finish).alias("at"))

    clean = F.aggregate(
        "_llm_spans", begin, cut, lambda done: F.concat(F.array_join(done.out, ""), F.substring(text, done.at + 1, F.length(text)))
    )
    masked_text = F.when(F.size("_llm_spans") > 0, clean).otherwise(text).alias("text")
    return rows.select(*(masked_text if c == "text" else F.col("_llm_all")[c].alias(c) for c in docs.columns))
