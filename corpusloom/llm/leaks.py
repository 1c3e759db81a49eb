"""Operator 2: benchmark decontamination by spaced-seed hashing.

A mask marks which of its word positions count. All masks are laid at every
word of the benchmark items and of the documents; where the marked words hash
alike, the other positions may differ. Around each such hit the document is
compared with the whole item along the hit's diagonal, and the longest stretch
that includes the hit with at least IDENTITY of its words equal is kept. A
document leaks an item when that stretch holds MIN_WORDS equal words, or
IDENTITY of the item's words if the item is shorter; where the longest holds
too few, the one with the most equal words counts.

The masks of an item are a family found by its length (``family``): whichever
words an accepted stretch of such an item may change, one mask of the family
fits into it with all its marked words equal. Items of 16 words and more have
four masks of six words; shorter ones allow fewer changes and have masks of their own.
A family is proven by looking at every allowed pattern, not by chance.

Items without words match nothing. Null and empty texts leak nothing; repeated
documents or items give one row per (doc_id, item_id); a null id stays a null id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import texts
from corpusloom.session import stage, work_dir

MIN_WORDS = 13
IDENTITY = 0.8
# Bytes of benchmark text that may be sent to every task; a larger benchmark is compared in parts.
MAX_SENT_BYTES = 16 << 20
# Masks are 1 for a word that counts: words that count and masks of a family at most, and the longest mask.
WEIGHT, FAMILY, SPAN = 6, 4, 11
# Patterns of equal and other words that may be looked at to prove a family.
MAX_PATTERNS = 2_000_000
# Meetings of a document's and an item's seed compared at a time.
BLOCK_HITS = 1 << 18
# Words of diagonals compared at a time, so that temporary arrays stay small.
BLOCK_WORDS = 1 << 20

DDL = "doc_id long, item_id long, first_word long, last_word long, n_equal long, share double"
SCHEMA = pa.schema([(n, pa.int64()) for n in ("doc_id", "item_id", "first_word", "last_word", "n_equal")] + [("share", pa.float64())])
_STEP = np.uint64(0xD6E8FEB86659FD93)


def seeds(hashed: np.ndarray, doc: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of a mask laid at every word where it fits into the text."""
    n = len(hashed) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.full(n, len(mask), np.uint64)
    for k, used in enumerate(mask):
        if used == "1":
            total = (total ^ hashed[k : n + k]) * _STEP
            total ^= total >> np.uint64(29)
    at = np.flatnonzero(doc[:n] == doc[len(mask) - 1 :])
    return at, total[at]


def words_needed(size: int, min_words: int, identity: float) -> int:
    """Equal words that a stretch of an item of this size must hold."""
    return max(1, min(min_words, ceil(identity * size - 1e-9)))


def patterns(size: int, others: int) -> np.ndarray:
    """Every row of ``size`` words with ``others`` of them changed, as bits of the equal ones."""
    places = np.array(list(combinations(range(size), others)), np.int64).reshape(comb(size, others), others)
    return ((1 << size) - 1) - (np.int64(1) << places).sum(axis=1)


def fits(pattern: np.ndarray, size: int, mask: str) -> np.ndarray:
    """Whether the mask lies somewhere in each pattern with equal words under all its ones."""
    bits, found = int(mask[::-1], 2), np.zeros(len(pattern), bool)
    for shift in range(size - len(mask) + 1):
        found |= (pattern & (bits << shift)) == bits << shift
    return found


def hardest(size: int, min_words: int, identity: float) -> list[tuple[int, int]]:
    """(words, changed words) of the shortest accepted stretches, one for each number of changed words.

    A longer stretch with as many changes holds such a one. A stretch of twice
    the length at which identity alone gives enough equal words holds an
    accepted half, so no longer ones need to be looked at.
    """
    need = words_needed(size, min_words, identity)
    longest = min(size, 2 * ceil(need / identity) - 1) if identity > 0 else size
    found = []
    for others in range(longest):
        equal = max(need, ceil(others * identity / (1 - identity) - 1e-9)) if identity < 1 else need
        if equal + others > longest or (others and identity >= 1):
            break
        found.append((equal + others, others))
    # one word and one change more: masks that fit there fit without them
    return [(n, others) for n, others in found if (n + 1, others + 1) not in found]


@lru_cache(maxsize=256)
def family(size: int, min_words: int, identity: float) -> tuple[str, ...]:
    """Masks of which one fits into every accepted stretch of an item of this size.

    Greedy: the mask that fits into most of the patterns left is taken until
    none is left, with as many counting words as FAMILY masks allow. Every mask
    ignores a word, unless a stretch of one or two equal words is enough.
    """
    need = words_needed(size, min_words, identity)
    if need <= 2:
        return ("1" * need,)
    stretches = hardest(size, min_words, identity)
    if sum(comb(*s) for s in stretches) > MAX_PATTERNS:
        raise ValueError("identity is too low: the changes it allows are too many to prove masks for")
    every = [(n, patterns(n, others)) for n, others in stretches]
    for weight in range(min(WEIGHT, need - 1), 1, -1):
        masks = _greedy(every, weight, FAMILY if weight > 2 else size)
        if masks:
            return masks
    raise ValueError("no masks found")


def _greedy(every: list[tuple[int, np.ndarray]], weight: int, most: int) -> tuple[str, ...]:
    masks: list[str] = []
    for size, left in every:
        for mask in masks:
            left = left[~fits(left, size, mask)]
        while len(left):
            few = left[:: max(1, len(left) // 3000)]
            tried = [(int(fits(few, size, mask).sum()), mask) for mask in _masks(min(size, SPAN), weight)]
            best, mask = max(tried, default=(0, ""), key=lambda t: t[0])
            if not best or len(masks) == most:
                return ()
            masks.append(mask)
            left = left[~fits(left, size, mask)]
    return tuple(masks)


def _masks(longest: int, weight: int) -> Iterator[str]:
    for span in range(weight + 1, longest + 1):
        for inner in combinations(range(1, span - 1), weight - 2):
            yield "".join("1" if k in (0, span - 1) or k in inner else "0" for k in range(span))


class Benchmark:
    """Seeds of the items, looked up by hash."""

    def __init__(self, ids: list, items: list[str | None], min_words: int, identity: float):
        raw, at = texts.flat(pa.array([t or "" for t in items], pa.string()))
        w = texts.words(raw, at, texts.WORD_BYTES)
        self.ids, self.hash, self.min_words, self.identity = ids, w.hash, min_words, identity
        size = np.bincount(w.doc, minlength=len(items))
        self.first, self.size = np.cumsum(size) - size, size
        sizes, at_size = np.unique(size, return_inverse=True)
        self.need = np.array([words_needed(int(n), min_words, identity) for n in sizes], np.int64)[at_size]
        # beyond some length all items have one family
        same = ceil(min_words / identity) if identity > 0 else int(size.max(initial=0))
        families = [set(family(int(n) if n < same else 2 * same, min_words, identity)) if n else set() for n in sizes]
        self.masks = sorted(set().union(*families))
        keys, items_at, places, kinds = ([np.zeros(0, t)] for t in (np.uint64, np.int64, np.int64, np.int64))
        for k, mask in enumerate(self.masks):
            pos, key = seeds(w.hash, w.doc, mask)
            mine = np.array([mask in f for f in families], bool)[at_size][w.doc[pos]]
            pos, key = pos[mine], key[mine]
            keys.append(key)
            items_at.append(w.doc[pos])
            places.append(pos - self.first[w.doc[pos]])
            kinds.append(np.full(len(pos), k))
        key, item, place, kind = map(np.concatenate, (keys, items_at, places, kinds))
        order = np.argsort(key, kind="stable")
        self.key, self.item, self.place, self.kind = key[order], item[order], place[order], kind[order]
        self.bits = np.zeros(1 << 21, bool)
        self.bits[(self.key >> np.uint64(43)).astype(np.int64)] = True

    def hits(self, w: texts.Words, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Rows (document, item, shift of the item's first word, seed) whose diagonals hold enough equal words, each once.

        They are compared BLOCK_HITS at a time: a seed that many items share
        takes no more memory than any other.
        """
        found = [np.zeros((0, 4), np.int64)]
        for k, mask in enumerate(self.masks):
            pos, key = seeds(w.hash, w.doc, mask)
            maybe = np.flatnonzero(self.bits[(key >> np.uint64(43)).astype(np.int64)])
            pos, key = pos[maybe], key[maybe]
            a, b = np.searchsorted(self.key, key, "left"), np.searchsorted(self.key, key, "right")
            pos, a, n = pos[b > a], a[b > a], (b - a)[b > a]
            total = np.cumsum(n)
            for x in range(0, int(total[-1]) if len(total) else 0, BLOCK_HITS):
                met = np.arange(x, min(x + BLOCK_HITS, int(total[-1])))
                of = np.searchsorted(total, met, "right")
                at = a[of] + met - (total[of] - n[of])
                here = pos[of]
                rows = np.stack([w.doc[here], self.item[at], here - self.place[at], here], axis=1)[self.kind[at] == k]
                if len(rows):
                    found.append(self.enough(w, first, size, np.unique(rows, axis=0)))
        return np.unique(np.concatenate(found), axis=0)

    def enough(self, w: texts.Words, first: np.ndarray, size: np.ndarray, hits: np.ndarray) -> np.ndarray:
        """The hits whose whole diagonal holds as many equal words as the item needs."""
        new = np.concatenate([[True], (np.diff(hits[:, :3], axis=0) != 0).any(axis=1)])
        doc, item, shift = hits[new, :3].T
        a = np.maximum(shift, first[doc])
        n = np.minimum(shift + self.size[item], first[doc] + size[doc]) - a
        mine, count = self.first[item] + a - shift, np.zeros(len(a), np.int64)
        block = np.cumsum(n) // BLOCK_WORDS
        cuts = np.flatnonzero(np.diff(block)) + 1
        for x, y in zip([0, *cuts], [*cuts, len(a)]):
            begin = np.cumsum(n[x:y]) - n[x:y]
            place = np.arange(int(n[x:y].sum())) - np.repeat(begin, n[x:y])
            equal = w.hash[np.repeat(a[x:y], n[x:y]) + place] == self.hash[np.repeat(mine[x:y], n[x:y]) + place]
            count[x:y] = np.add.reduceat(equal.astype(np.int64), begin)
        return hits[(count >= self.need[item])[np.cumsum(new) - 1]]

    def verified(self, w: texts.Words, first: np.ndarray, size: np.ndarray, hit: np.ndarray):
        """(first word, last word, equal words) of the stretch around a hit, or None."""
        doc, item, shift, seed = (int(x) for x in hit)
        a = max(shift, int(first[doc]))
        b = min(shift + int(self.size[item]), int(first[doc] + size[doc]))
        mine = int(self.first[item]) + a - shift
        equal = w.hash[a:b] == self.hash[mine : mine + b - a]
        gain = np.concatenate([[0.0], np.cumsum(equal - self.identity)])
        k = seed - a
        # the earliest begin and the latest end whose stretch keeps the identity
        left, right = gain[: k + 1], gain[k + 1 :]
        best = np.maximum.accumulate(right[::-1])[::-1]  # best[e]: the highest gain at or behind e
        reach = np.searchsorted(-best, -(left - 1e-9), side="right") - 1
        if not len(reach) or reach.max() < 0:
            return None
        total = np.concatenate([[0], np.cumsum(equal)])
        most = np.where(reach >= 0, total[k + 1 + reach] - total[: k + 1], -1)
        x = int(np.argmax(np.where(reach >= 0, k + 1 + reach - np.arange(k + 1), -1)))
        x = x if most[x] >= self.need[item] else int(np.argmax(most))
        y, n = k + 1 + int(reach[x]), int(most[x])
        return (a + x - int(first[doc]), a + y - 1 - int(first[doc]), n) if n >= self.need[item] else None


def leaks(docs: DataFrame, items: DataFrame, min_words: int = MIN_WORDS, identity: float = IDENTITY) -> DataFrame:
    """One row per (doc_id, item_id) that overlap: the longest stretch, its equal words and their share of the item."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    sent = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = 1 + int(sent) // MAX_SENT_BYTES
    found = None
    # a benchmark over the bound is compared in parts, each under it
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    for k in range(parts):
        rows = items.where(part == k).collect()
        one = _leaks(docs, [r["item_id"] for r in rows], [r["text"] for r in rows], min_words, identity)
        found = one if found is None else found.unionByName(one)
    best = F.max(F.struct("n_equal", F.negate("first_word").alias("at"), "last_word", "share")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", F.negate("best.at").alias("first_word"), "best.last_word", "best.n_equal", "best.share"
    )


def _leaks(docs: DataFrame, ids: list, items: list, min_words: int, identity: float) -> DataFrame:
    bench = Benchmark(ids, items, min_words, identity) if ids else None

    def work(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if bench is None or not len(bench.key):
            return
        w = texts.words(*texts.flat(part.column("text")), texts.WORD_BYTES)
        size = np.bincount(w.doc, minlength=part.num_rows)
        first = np.cumsum(size) - size
        hits = bench.hits(w, first, size)
        names, out, done = part.column("doc_id").to_pylist(), [], {}
        for hit in hits:
            key = tuple(hit[:3].tolist())
            if done.get(key, -1) >= hit[3]:
                continue  # inside a stretch that is known
            got = bench.verified(w, first, size, hit)
            if got:
                done[key] = got[1] + int(first[key[0]])
                item = int(hit[1])
                out.append((names[int(hit[0])], bench.ids[item], *got, got[2] / int(bench.size[item])))
        if out:
            yield texts.record(SCHEMA, *zip(*out))

    return texts.map_texts(docs, work, DDL)


def decontaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents without those that leak any item; all columns are kept, rows without an id stay."""
    found = leaks(docs, items, **options).select(F.col("doc_id").alias("_leaked")).distinct()
    found = stage(found, work_dir(docs.sparkSession, "leaks"))
    return docs.join(found, docs["doc_id"] == found["_leaked"], "left_anti")
