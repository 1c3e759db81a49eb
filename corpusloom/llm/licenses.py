"""Operator 9: license scans as an exact set-similarity join.

Text blocks are windows of 2 S words, S apart, where S is the template's length:
any S words of a text lie in one block, and a short template has short blocks. A
block contains a template when it holds at least the threshold share of the
template's distinct words, the words that name the license among them: without
those, "released under the old license" would be any license at all. Words are
ordered by how often the whole corpus uses them, rare first. A template's prefix
is so long that a block without any prefix word cannot reach the threshold;
blocks that hold one must also pass the length filter (enough template words at
all) and the positional filter (enough of them behind the first shared one)
before the overlap is counted.

The license phrases are searched beside it, word by word. Null and empty texts
have no words, no places and score 0; rows are kept as they are, repeated or not.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import texts

# Phrases whose places are counted, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Sentences by which licenses are granted, their labels and the words in them that tell them from plain prose.
TEMPLATES = (
    ("this work is licensed under the gnu general public license version 3", "gpl", "gnu"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation", "gpl", "gnu foundation"),
    ("licensed under the apache license version 2 0", "apache", "apache"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache", "compliance license"),
    ("licensed under cc by nc 4 0", "cc-by-nc", "cc by nc"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by", "creative commons attribution"),
    ("released under the mit license", "mit", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files", "mit", "granted charge"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met", "bsd", "redistribution source binary"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl", "mozilla"),
)
THRESHOLD = 0.8
# Template words are sent to every task: this many at most.
MAX_TEMPLATE_WORDS = 100_000

SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
])
DDL = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
)


def hashes(phrase: str) -> np.ndarray:
    raw = np.frombuffer(phrase.encode(), np.uint8)
    return texts.words(raw, np.array([0, len(raw)]), texts.WORD_BYTES).hash


def word_counts(docs: DataFrame, vocabulary: np.ndarray) -> dict[int, int]:
    """How often the corpus uses each template word: as many rows as there are template words."""
    schema = pa.schema([("word", pa.int64()), ("n", pa.int64())])

    def work(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        w = texts.words(*texts.flat(part.column("text")), texts.WORD_BYTES)
        found, n = np.unique(place(vocabulary, w.hash), return_counts=True)
        yield texts.record(schema, vocabulary[found[found >= 0]].view(np.int64), n[found >= 0])

    counted = texts.map_texts(docs, work, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r["word"] & (2**64 - 1): r["n"] for r in counted.collect()}


def place(vocabulary: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Place of each hash in the sorted vocabulary, or -1."""
    at = np.minimum(np.searchsorted(vocabulary, hashed), len(vocabulary) - 1)
    return np.where(vocabulary[at] == hashed, at, -1)


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: phrase places, labels of phrases and contained templates, best containment.

    Templates of more than MAX_TEMPLATE_WORDS different words are refused; scan with a part of them at a time.
    """
    sets = [np.unique(hashes(t)) for t, _, _ in templates]
    vocabulary = np.unique(np.concatenate(sets))
    if len(vocabulary) > MAX_TEMPLATE_WORDS:
        raise ValueError("too many template words to send to every task; scan with a part of the templates at a time")
    counts = word_counts(docs, vocabulary)
    # rank of each vocabulary word in the global order, rare first
    order = sorted(range(len(vocabulary)), key=lambda k: (counts.get(int(vocabulary[k]), 0), k))
    rank = np.empty(len(vocabulary), np.int64)
    rank[order] = np.arange(len(vocabulary))
    ordered = [np.sort(rank[place(vocabulary, s)]) for s in sets]
    needed = [ceil(threshold * len(s) - 1e-9) for s in sets]
    musts = [rank[place(vocabulary, hashes(m))] for _, _, m in templates]
    # by template length: the templates' words, and the templates by each word of their prefixes
    by_span: dict[int, tuple[np.ndarray, np.ndarray, dict[int, list[int]]]] = {}
    for t, (words, need) in enumerate(zip(ordered, needed)):
        of_any, in_prefix, by_prefix = by_span.setdefault(
            len(hashes(templates[t][0])), (np.zeros(len(vocabulary), bool), np.zeros(len(vocabulary), bool), {})
        )
        of_any[words] = True
        for r in words[: len(words) - need + 1]:
            in_prefix[r] = True
            by_prefix.setdefault(int(r), []).append(t)
    wanted = [(hashes(p), label) for p, label in phrases.items()]

    def work(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        w = texts.words(*texts.flat(part.column("text")), texts.WORD_BYTES)
        n = part.num_rows
        size = np.bincount(w.doc, minlength=n)
        first = np.cumsum(size) - size
        base, n_base = [set() for _ in range(n)], np.zeros(n, np.int64)
        low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
        for phrase, label in wanted:
            k = len(phrase)
            at = np.flatnonzero(w.hash[: len(w.hash) - k + 1] == phrase[0]) if len(w.hash) >= k else np.zeros(0, np.int64)
            for j in range(1, k):
                at = at[w.hash[at + j] == phrase[j]]
            at = at[w.doc[at] == w.doc[at + k - 1]]
            docs_at, word = w.doc[at], at - first[w.doc[at]]
            np.add.at(n_base, docs_at, 1)
            np.minimum.at(low, docs_at, word)
            np.maximum.at(high, docs_at, word)
            for d in np.unique(docs_at).tolist():
                base[d].add(label)
        labels, score = [set(b) for b in base], np.where(n_base > 0, 1.0, 0.0)
        for d, t, share in contained(w, first):
            labels[d].add(templates[t][1])
            score[d] = max(score[d], share)
        none = n_base == 0
        yield texts.record(
            SCHEMA, part.column("doc_id"), size, n_base, pa.array(low, mask=none), pa.array(high, mask=none),
            [",".join(sorted(b)) for b in base], [",".join(sorted(x)) for x in labels], score,
        )

    def contained(w: texts.Words, first: np.ndarray) -> Iterator[tuple[int, int, float]]:
        at = place(vocabulary, w.hash)
        hit = np.flatnonzero(at >= 0)
        for span in by_span:
            yield from of_length(span, w.doc[hit], hit - first[w.doc[hit]], rank[at[hit]])

    def of_length(span: int, docs_at: np.ndarray, words_at: np.ndarray, ranks: np.ndarray) -> Iterator[tuple[int, int, float]]:
        of_any, in_prefix, by_prefix = by_span[span]
        mine = of_any[ranks]
        docs_at, block, ranks = docs_at[mine], words_at[mine] // span, ranks[mine]
        # a word lies in the block that begins with its stretch and in the one before it
        docs2, ranks2, block2 = np.tile(docs_at, 2), np.tile(ranks, 2), np.concatenate([block, block - 1])
        named = docs2 * (int(block.max(initial=0)) + 2) + block2 + 1
        # only blocks that hold a prefix word
        real = (block2 >= 0) & np.isin(named, named[in_prefix[ranks2]])
        if not real.any():
            return
        rows = np.unique(np.stack([docs2[real], block2[real], ranks2[real]], axis=1), axis=0)
        new = np.flatnonzero(np.any(rows[1:, :2] != rows[:-1, :2], axis=1)) + 1
        begins, ends = np.concatenate([[0], new]), np.concatenate([new, [len(rows)]])
        for a, b in zip(begins.tolist(), ends.tolist()):
            mine = rows[a:b, 2]
            seen = set()
            for j, r in enumerate(mine.tolist()):
                for t in by_prefix.get(r, ()):
                    if t in seen:
                        continue
                    seen.add(t)  # r is the first word they share
                    words, need = ordered[t], needed[t]
                    i = int(np.searchsorted(words, r))
                    if len(mine) < need or min(len(words) - i, len(mine) - j) < need:
                        continue
                    shared = len(np.intersect1d(words, mine, assume_unique=True))
                    if shared >= need and np.isin(musts[t], mine).all():
                        yield int(rows[a, 0]), t, shared / len(words)

    return texts.map_texts(docs, work, DDL)
