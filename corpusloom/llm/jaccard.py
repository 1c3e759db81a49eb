"""Operator 6: n-gram Jaccard join by T-occurrence search.

Two sets with a Jaccard similarity of t or more share at least T of their
shingles, so a document's partners are those that occur at least T times on the
inverted lists of its shingles. As in DivideSkip, long lists are kept out of the
merge: they are put last in the order of all shingles, and of each set only its
first n - ceil(t n) + 1 shingles in that order are listed, which any partner must
meet. Counting a pair's common listed shingles is the merge; pairs whose count
shows that too many others cannot be common are dropped. What is left is
decided on whole sets: the short lists of a query's candidates are merged, and
only candidates that may still reach T are probed in the long lists by binary
search.

Equal sets are one class from the start. Links first go from each list's first
set to its others, then, on lists where many sets are outside the component of
most, from further heads to sets of about their size, in turns. Only sets of different
components are compared further, so a list of thousands of near copies costs its
length, not its square, whichever set comes first. Two sets that
share many lists are a pair on few of them; candidates are chosen by listed
shingles, as in a prefix join, and merging and probing decide on whole sets.

Texts without words have no shingles and link nothing; with fewer words than a
shingle has, the whole sequence is one. A null text is an empty one; a row
without an id has a null component; rows of one id are one node.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm import graph, texts
from corpusloom.session import own_tables, stage, work_dir

SHINGLE_WORDS, PERCENT = 5, 80
# Long lists are those of LONG_LIST documents and more; their shingles are sent to every task. The length grows with
# the corpus, so that there are at most MAX_LONG of them.
LONG_LIST, MAX_LONG = 64, 1 << 16
# A list with more sets than this outside the component of most gets further heads, one in each turn.
MANY_OUTSIDE, TURNS = 16, 2
# The lists before this one that each row names; two sets that name a common one have met there.
BEFORE = ("before1", "before2")
# Ids that may be sent to every task to pick their texts or sketches; more of them are joined instead.
MAX_SENT_IDS = 1_000_000

_SETS = "doc_id long, n int, hash1 long, hash2 long, low array<long>"
_BITS = ("bits0", "bits1", "bits2", "bits3")
# What is known of a set on every list: its bits, and where its own list ends in the order of all shingles.
_FACTS = (*_BITS, "ending")
_LISTED = f"doc_id long, n int, {' long, '.join(_BITS)} long, ending int, listed array<long>, wide array<long>"
# Bits of the wide sketch, for pairs; those that every list carries tell long sets apart no more.
WIDE_BITS = 2048


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    w = texts.words(*texts.flat(column))
    doc, hashed = texts.runs(w, k)
    at = np.searchsorted(doc, np.arange(len(column) + 1))
    size = np.bincount(w.doc, minlength=len(column))
    first = np.cumsum(size) - size
    sets = [np.unique(hashed[a:b]) for a, b in zip(at, at[1:])]
    for d in np.flatnonzero((size > 0) & (size < k)).tolist():
        whole = w.hash[first[d] : first[d] + size[d]]
        value = np.uint64(size[d])
        for h in whole[None].T:
            value = texts.mix(h ^ value)
        sets[d] = np.asarray(value, np.uint64).reshape(1)
    return sets


def listed_size(n, percent: int):
    """How many of n shingles a set must list so that any partner meets one."""
    return n - -(-percent * n // 100) + 1


def _signatures(docs: DataFrame, k: int, percent: int) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("hash1", pa.int64()), ("hash2", pa.int64()), ("low", pa.list_(pa.int64()))])

    def work(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sets = shingle_sets(part.column("text"), k)
        sums = [(int(s.sum(dtype=np.uint64)), int(texts.mix(s ^ np.uint64(k)).sum(dtype=np.uint64))) for s in sets]
        low = [s[: 3 * listed_size(len(s), percent) // 2].view(np.int64) if len(s) else s.view(np.int64) for s in sets]
        one, two = (np.array([x[j] for x in sums], np.uint64).view(np.int64) for j in (0, 1))
        yield texts.record(schema, part.column("doc_id"), [len(s) for s in sets], one, two, pa.array(low, pa.list_(pa.int64())))

    return texts.map_texts(docs, work, _SETS)


def _long(signatures: DataFrame) -> np.ndarray:
    """Shingles of long lists, MAX_LONG at most: as many rows cannot reach the length."""
    rows = signatures.agg(F.sum(F.size("low")).alias("n")).first()["n"] or 0
    length = max(LONG_LIST, -(-rows // MAX_LONG))
    counts = signatures.select(F.explode("low").alias("shingle")).groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    found = counts.where(F.col("n") >= length).select("shingle").toArrow().column("shingle")
    return np.sort(found.to_numpy().view(np.uint64))


def _lists(docs: DataFrame, long: np.ndarray, k: int, percent: int) -> DataFrame:
    """(doc_id, n, bits, ending, listed): a set's first shingles, those of long lists last; each shingle turns one of 256 bits over.

    ``ending`` is the place of the last listed one in that order; its lower half is left out.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), *((b, pa.int64()) for b in _BITS), ("ending", pa.int32()), ("listed", pa.list_(pa.int64())), ("wide", pa.list_(pa.int64()))])

    def turned(sets: list[np.ndarray], bits: int) -> np.ndarray:
        """A row of bits per set; each shingle turns one of them over."""
        shift = np.uint64(64 - bits.bit_length() + 1)
        odd = np.array([np.bincount((s >> shift).astype(np.int64), minlength=bits) & 1 for s in sets], np.uint8)
        return np.packbits(odd.reshape(-1, bits), axis=1).view(np.int64)

    def is_long(s: np.ndarray) -> np.ndarray:
        if not len(long):
            return np.zeros(len(s), bool)
        return long[np.minimum(np.searchsorted(long, s), len(long) - 1)] == s

    def first(s: np.ndarray) -> np.ndarray:
        size = listed_size(len(s), percent)
        for stretch in (s[: 2 * size], s):
            last = is_long(stretch)
            short = stretch[~last][:size]
            if len(short) == size:
                return short
        return np.concatenate([short, s[last][: size - len(short)]])

    def work(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sets = shingle_sets(part.column("text"), k)
        kept = [i for i, s in enumerate(sets) if len(s)]
        bits, wide = (turned([sets[i] for i in kept], n) for n in (256, WIDE_BITS))
        listed = [first(sets[i]) for i in kept]
        last = np.array([x[-1] for x in listed], np.uint64)
        ending = ((last >> np.uint64(34)) | (is_long(last).astype(np.uint64) << np.uint64(30))).astype(np.int32)
        listed = pa.array([x.view(np.int64) for x in listed], pa.list_(pa.int64()))
        yield texts.record(schema, part.column("doc_id").take(pa.array(kept, pa.int64())), [len(sets[i]) for i in kept], *bits.T, ending, listed, pa.array(list(wide), pa.list_(pa.int64())))

    return texts.map_texts(docs, work, _LISTED)


def _common_least(a: Column, b: Column, percent: int) -> Column:
    """Shingles that sets of these sizes must share."""
    return F.ceil(percent * (a + b) / F.lit(100 + percent)).cast("int")


def _may_link(one: Callable[[str], Column], two: Callable[[str], Column], percent: int) -> Column:
    """Whether sizes, shingles of their own and bits of two sets allow the similarity.

    Bits that differ are differing shingles, at least as many. So are the listed
    shingles that no other set lists, of the set whose list ends first: its partner
    would list them as well. Those of the other set may stand behind that end, in both.
    """
    n1, n2 = one("n"), two("n")
    apart = F.lit(0)
    for b in _BITS:
        apart = apart + F.bit_count(one(b).bitwiseXOR(two(b)))
    sizes = 100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)
    most = n1 + n2 - 2 * _common_least(n1, n2, percent)
    own = F.when(one("ending") < two("ending"), one("single")).when(two("ending") < one("ending"), two("single"))
    return sizes & (own.otherwise(F.least(one("single"), two("single"))) <= most) & (apart <= most)


def overlaps(query: np.ndarray, sets: list[np.ndarray], need: np.ndarray) -> np.ndarray:
    """Common shingles of a query with each of its candidates; 0 where fewer than ``need``.

    The lists of the query's shingles over the candidates are divided: all but
    the T - 1 longest are merged, and what may still reach its T is probed in the rest.
    """
    place = [np.searchsorted(query, s) for s in sets]
    hit = [(p < len(query)) & (query[np.minimum(p, len(query) - 1)] == s) for p, s in zip(place, sets)]
    token = np.concatenate([p[h] for p, h in zip(place, hit)])
    owner = np.repeat(np.arange(len(sets)), [int(h.sum()) for h in hit])
    length = np.bincount(token, minlength=len(query))
    n_long = max(0, int(need.min()) - 1)
    long = np.zeros(len(query), bool)
    long[np.argsort(-length, kind="stable")[:n_long]] = True
    count = np.bincount(owner[~long[token]], minlength=len(sets))
    probed = query[long]
    for c in np.flatnonzero(count >= np.maximum(need - n_long, 0)).tolist():
        at = np.searchsorted(sets[c], probed)
        count[c] += int((sets[c][np.minimum(at, len(sets[c]) - 1)] == probed).sum())
    return np.where(count >= need, count, 0)


def _of_pairs(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows whose doc_id is in a pair."""
    spark = rows.sparkSession
    ids = pairs.select(F.col("a").alias("_id")).union(pairs.select(F.col("b").alias("_id"))).distinct()
    ids = stage(ids, work_dir(spark, "pair-ids"))
    chosen = F.broadcast(ids) if ids.count() <= MAX_SENT_IDS else ids
    return rows.join(chosen, F.col("doc_id") == F.col("_id"), "left_semi")


def _verified(docs: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b) of the pairs that are similar enough, decided on whole sets."""
    spark = docs.sparkSession
    pairs = stage(pairs, work_dir(spark, "pairs"))
    rows = _of_pairs(docs.select("doc_id", "text"), pairs)
    schema = pa.schema([("doc_id", pa.int64()), ("set", pa.binary())])

    def build(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield texts.record(schema, part.column("doc_id"), [s.tobytes() for s in shingle_sets(part.column("text"), k)])

    sets = stage(texts.map_texts(rows, build, "doc_id long, set binary"), work_dir(spark, "sets"))
    one, two = sets.select(F.col("doc_id").alias("a"), F.col("set").alias("set_a")), sets.select(F.col("doc_id").alias("b"), F.col("set").alias("set_b"))
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            queries, candidates = batch.column("set_a"), batch.column("set_b")
            good, cuts = [], np.flatnonzero(np.diff(a)) + 1
            for x, y in zip([0, *cuts], [*cuts, len(a)]):
                query = np.frombuffer(queries[int(x)].as_py(), np.uint64)
                found = [np.frombuffer(candidates[j].as_py(), np.uint64) for j in range(x, y)]
                total = len(query) + np.array([len(s) for s in found])
                good.append(overlaps(query, found, -(-percent * total // (100 + percent))) > 0)
            yield texts.record(out, a, b).filter(pa.array(np.concatenate(good)))

    # the candidates first: of their two shuffles the wide one goes by the key that is not hot
    return pairs.join(two, "b").join(one, "a").select("a", "b", "set_a", "set_b").mapInArrow(search, "a long, b long")


def near_components(docs: DataFrame, k: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id): the smallest document that can be reached by links, itself included.

    The result is written; every table on the way is deleted once the next ones no longer need it.
    """
    spark = docs.sparkSession
    result = work_dir(spark, "near-components")
    with own_tables(spark):
        return stage(_near_components(docs, k, percent), result)


def _near_components(docs: DataFrame, k: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    sizes_at = work_dir(spark, "sizes")
    with own_tables(spark):
        signatures = stage(_signatures(docs, k, percent), work_dir(spark, "signatures"))
        long = _long(signatures.where("doc_id is not null"))
        sizes = stage(signatures.drop("low"), sizes_at)
    one = F.min("doc_id").alias("one")
    classes = sizes.where("n > 0").groupBy("hash1", "hash2", "n").agg(one).where("one is not null")
    classes = stage(classes, work_dir(spark, "classes"))

    lists_at = work_dir(spark, "sketches")
    lists = stage(_lists(docs.where(F.col("doc_id").isNotNull()), long, k, percent), lists_at)
    met_at, known_at = (work_dir(spark, n) for n in ("met", "sure-components"))
    with own_tables(spark):
        entries_at, sure_at, links_at = (work_dir(spark, n) for n in ("known-entries", "sure", "sure-links"))
        with own_tables(spark):
            mine = classes.select(F.col("one").alias("doc_id"))
            entries, facts = _entries(lists.drop("wide").join(mine, "doc_id", "left_semi"))
            entries = stage(entries, entries_at)
            sure = stage(_to_heads(entries, facts, percent), sure_at)
        with own_tables(spark):
            links = stage(_verified(docs, _meeting(sure, lists, percent), k, percent), links_at)
        contested, known = _merged(docs, lists, entries, links, known_at, k, percent)
        rows = stage(_placed(entries, known).join(contested, "shingle"), work_dir(spark, "contested-lists"))
        met = stage(_across(rows, percent), met_at)
    rest = _verified(docs, _meeting(met, lists, percent), k, percent)
    links = known.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b")).union(rest)
    found = stage(graph.components(links), work_dir(spark, "components"))
    placed = classes.join(found, classes["one"] == found["node"], "left")
    placed = stage(
        placed.select("hash1", "hash2", F.col("n").alias("_n"), F.coalesce("component", "one").alias("component_id")),
        work_dir(spark, "placed"),
    )
    joined = sizes.join(placed, ["hash1", "hash2"], "left").where("_n is null or _n = n")
    return joined.select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def _entries(lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(shingle, doc_id, before, n, bits, ending, single) of all listed shingles that two sets or more list; and the facts of each set.

    ``single`` counts the listed shingles a set shares with none. ``before`` are the set's lists next to this one.
    """
    spark = lists.sparkSession
    lists = stage(lists, work_dir(spark, "lists"))
    entries = lists.select(F.explode("listed").alias("shingle"), "doc_id")
    often = entries.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("shingle")
    often = stage(often, work_dir(spark, "often"))
    entries = stage(entries.join(often, "shingle"), work_dir(spark, "entries"))
    counts = entries.groupBy("doc_id").agg(F.count(F.lit(1)).alias("common"))
    facts = lists.select("doc_id", "n", *_FACTS, F.size("listed").alias("listed")).join(counts, "doc_id")
    facts = facts.select("doc_id", "n", *_FACTS, (F.col("listed") - F.col("common")).cast("int").alias("single"))
    facts = stage(facts, work_dir(spark, "facts"))
    mine = Window.partitionBy("doc_id").orderBy("shingle")
    entries = entries.select("shingle", "doc_id", *(F.lag("shingle", k + 1).over(mine).alias(b) for k, b in enumerate(BEFORE)))
    return entries.join(facts, "doc_id"), facts


def _to_heads(entries: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of each list's head and the sets on it that may link with it.

    The head is the set with the fewest shingles of its own: the one most like all others.
    """
    spark = entries.sparkSession
    heads = entries.groupBy("shingle").agg(F.min(F.struct("single", "n", "doc_id")).alias("head"))
    heads = stage(heads.select("shingle", F.col("head.doc_id").alias("first")), work_dir(spark, "firsts"))
    head = F.struct("n", *_FACTS, "single").alias("head")
    heads = heads.join(facts.select(F.col("doc_id").alias("first"), head), "first")
    met = entries.drop(*BEFORE).join(stage(heads, work_dir(spark, "heads")), "shingle").where("doc_id <> first")
    met = met.where(_may_link(F.col, lambda c: F.col(f"head.{c}"), percent))
    return met.select(F.col("first").alias("a"), F.col("doc_id").alias("b")).distinct()


def _placed(entries: DataFrame, known: DataFrame) -> DataFrame:
    """The entries with ``inside``, the component of each set."""
    known = known.select(F.col("node").alias("doc_id"), "component")
    return entries.join(known, "doc_id", "left").withColumn("inside", F.coalesce("component", "doc_id")).drop("component")


def _contested(entries: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """(shingle, main, outside) of the lists that hold sets of two components or more.

    ``main`` is the component of most of its sets, ``outside`` counts the others. Lists of
    two components whose sizes are too far apart for any link are left out.
    """
    rows = _placed(entries.select("shingle", "doc_id", "n"), known).select("shingle", "inside", "n")
    # one shuffle for both groupings
    parts = rows.repartition("shingle").groupBy("shingle", "inside").agg(
        F.count(F.lit(1)).alias("sets"), F.min("n").alias("low"), F.max("n").alias("high")
    )
    lists = parts.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("parts"), F.max(F.struct("sets", "inside", "low", "high")).alias("main"),
        *(F.sum(c).alias(c) for c in ("sets", "low", "high")),
    )
    main = {c: F.col(f"main.{c}") for c in ("sets", "inside", "low", "high")}
    low, high = F.col("low") - main["low"], F.col("high") - main["high"]  # of the other part, where there are two
    apart = (F.col("parts") == 2) & ((100 * high < percent * main["low"]) | (100 * main["high"] < percent * low))
    return lists.where((F.col("parts") > 1) & ~apart).select("shingle", main["inside"].alias("main"), (F.col("sets") - main["sets"]).alias("outside"))


def _merged(docs: DataFrame, lists: DataFrame, entries: DataFrame, links: DataFrame, known_at: str, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The contested lists, and the components known by ``links`` and by those found in turns.

    On a list with many sets outside the component of most, two heads of each size, one in that component and one outside,
    are compared with the others of about that size, other heads in each turn. That merges a large group of near
    copies where the first set of their lists is unlike them.
    """
    spark = docs.sparkSession
    places = [work_dir(spark, n) for n in ("contested", "crowded", "known")]
    with own_tables(spark):
        known = stage(graph.components(links), places[2])
    contested = stage(_contested(entries, known, percent), places[0])
    crowd = contested.where(F.col("outside") > MANY_OUTSIDE)
    if crowd.isEmpty():
        return contested, stage(known, known_at)
    crowded = stage(entries.join(crowd.select("shingle"), "shingle", "left_semi"), places[1])
    for turn in range(TURNS):
        links_at, next_at = (work_dir(spark, n) for n in ("turn-links", "known"))
        with own_tables(spark):
            rows = _placed(crowded, known).join(crowd, "shingle").withColumn("in_main", F.col("inside") == F.col("main"))
            # sets of about one size; every other turn cuts the sizes at other places
            band = F.floor(F.log("n") / math.log(100 / min(percent, 99)) + turn / 2).alias("band")
            rows = stage(rows.select("shingle", "doc_id", "n", *_FACTS, "single", "inside", "in_main", band), work_dir(spark, "placed"))
            facts = F.struct("single", F.xxhash64("doc_id", F.lit(turn)).alias("order"), "doc_id", "n", *_FACTS, "inside")
            heads = rows.groupBy("shingle", "band", "in_main").agg(F.min(facts).alias("head")).drop("in_main")
            met = rows.join(stage(heads, work_dir(spark, "turn-heads")), ["shingle", "band"]).where("inside <> head.inside")
            met = met.where(_may_link(F.col, lambda c: F.col(f"head.{c}"), percent))
            met = met.select(F.least("doc_id", "head.doc_id").alias("a"), F.greatest("doc_id", "head.doc_id").alias("b")).distinct()
            found = stage(_verified(docs, _meeting(met, lists, percent), k, percent), links_at)
            if found.isEmpty():
                break
            before = known.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
            known = stage(graph.components(before.union(found)), next_at)
            crowd = stage(_contested(crowded, known, percent), work_dir(spark, "crowd")).where(F.col("outside") > MANY_OUTSIDE)
            if crowd.isEmpty():
                break
            crowd = stage(crowd, f"{next_at}-crowd")
    return stage(_contested(entries, known, percent), work_dir(spark, "contested")), stage(known, known_at)


def _across(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different known components that meet on a list.

    On each list the sets outside its main component are compared
    with all others; lists within one component have none. Two sets that name a
    common list before this one are a pair there and not here once more; on the first
    list that they share they name none.
    """
    other = rows.where("inside <> main")
    met = other.alias("a").join(rows.alias("b"), "shingle")
    met = met.where("a.inside <> b.inside and (b.inside = b.main or a.doc_id < b.doc_id)")
    met = met.where(_may_link(lambda c: F.col(f"a.{c}"), lambda c: F.col(f"b.{c}"), percent))
    again = " or ".join(f"a.{x} = b.{y}" for x in BEFORE for y in BEFORE)
    met = met.where(f"not coalesce({again}, false)")
    return met.select(F.least("a.doc_id", "b.doc_id").alias("a"), F.greatest("a.doc_id", "b.doc_id").alias("b")).distinct()


def _meeting(pairs: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose wide sketches, and then their listed shingles, a tenth or a fifth of all, allow the similarity."""
    spark = pairs.sparkSession

    def with_both(pairs: DataFrame, column: str) -> DataFrame:
        mine = stage(_of_pairs(lists.select("doc_id", "n", column), pairs), work_dir(spark, column))
        for c in ("a", "b"):
            pairs = pairs.join(mine.select(F.col("doc_id").alias(c), F.col("n").alias(f"n_{c}"), F.col(column).alias(f"{column}_{c}")), c)
        return pairs

    sketched = with_both(stage(pairs, work_dir(spark, "met")), "wide")
    turned = F.zip_with("wide_a", "wide_b", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    apart = F.aggregate(turned, F.lit(0), lambda n, x: n + x)
    most = F.col("n_a") + F.col("n_b") - 2 * _common_least(F.col("n_a"), F.col("n_b"), percent)
    near = stage(sketched.where(apart <= most).select("a", "b"), work_dir(spark, "near"))
    counted = with_both(near, "listed").withColumn("met", F.size(F.array_intersect("listed_a", "listed_b")))
    least = _common_least(F.col("n_a"), F.col("n_b"), percent)

    def spared(n: Column) -> Column:
        """Listed shingles that may be missed: of the set whose list ends first all others are missing in its partner."""
        listed = n - F.ceil(percent * n / F.lit(100)).cast("int") + 1
        return listed - F.col("met") <= n - least

    return counted.where(spared(F.col("n_a")) | spared(F.col("n_b"))).select("a", "b")


def one_of_each(docs: DataFrame, k: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents with one row of each component, the smallest id; rows without an id or without words stay."""
    found = near_components(docs, k, percent).where("component_id <> doc_id").select(F.col("doc_id").alias("_llm_copy")).distinct()
    found = stage(found, work_dir(docs.sparkSession, "copies"))
    return docs.join(found, docs["doc_id"] == found["_llm_copy"], "left_anti")
