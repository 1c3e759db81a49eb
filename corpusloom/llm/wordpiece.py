"""Operator 7: greedy word-piece counts by a linear longest-match automaton.

A trie over start pieces and, under a second root, continuation pieces gets
failure links: where no edge goes on, the link leads to the node that the rest
of the word reaches once the pieces matched so far are popped. Only how many
pieces a link pops is stored, so a word is counted in one pass, without ever
going back and without building a piece.

A word is a run of bytes without ASCII white space. A word that no pieces spell
counts as one unknown piece. Null and empty texts count nothing; rows are kept
as they are, repeated or not.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from corpusloom.llm import bpe, texts

# An unknown word's count in a sum of counts: above any number of pieces.
_UNKNOWN = 1 << 44

SCHEMA = pa.schema([(n, pa.int64()) for n in ("doc_id", "n_words", "n_unknown", "n_tokens")])


class Automaton(dict):
    """Pieces of a word by its bytes; an unknown word gives _UNKNOWN + 1."""

    START, REST = 0, 1

    def __init__(self, start: Iterable[bytes], rest: Iterable[bytes]):
        super().__init__()
        self.edges: dict[int, int] = {}
        self.links, self.popped = [-1, -1], [0, 0]
        level: list[tuple[int, int, int]] = []
        ends = set()
        for root, pieces in ((self.START, start), (self.REST, rest)):
            for piece in pieces:
                node = root
                for byte in piece:
                    key = node << 8 | byte
                    if key not in self.edges:
                        self.edges[key] = len(self.links)
                        level.append((node, byte, len(self.links)))
                        self.links.append(-1)
                        self.popped.append(0)
                    node = self.edges[key]
                if piece:
                    ends.add(node)
        depth = [0, 0] + [0] * (len(self.links) - 2)
        for parent, _, node in level:
            depth[node] = depth[parent] + 1
        for parent, byte, node in sorted(level, key=lambda x: depth[x[2]]):
            if node in ends:
                self.links[node], self.popped[node] = self.REST, 1
                continue
            count, at = self.popped[parent], self.links[parent]
            while at >= 0 and (at << 8 | byte) not in self.edges:
                count, at = count + self.popped[at], self.links[at]
            if at >= 0:
                self.links[node], self.popped[node] = self.edges[at << 8 | byte], count

    def __missing__(self, word: bytes) -> int:
        count = self.count(word)
        if len(word) <= bpe.MEMO_BYTES:
            bpe.remember(self, word, count)
        return count

    def count(self, word: bytes) -> int:
        edges, links, popped = self.edges, self.links, self.popped
        node, total = self.START, 0
        for byte in word:
            while (after := edges.get(node << 8 | byte)) is None:
                if links[node] < 0:
                    return _UNKNOWN + 1
                total, node = total + popped[node], links[node]
            node = after
        while node != self.REST:
            if links[node] < 0:
                return _UNKNOWN + 1
            total, node = total + popped[node], links[node]
        return total


def pieces(path: str) -> tuple[list[bytes], list[bytes]]:
    """Start and continuation pieces of a byte-level vocabulary: those after a space, and the others."""
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    letters = bpe.byte_letters()
    spelled = [bytes(letters[c] for c in token) for token in vocabulary]
    return [t[1:] for t in spelled if t[:1] == b" " and t[1:]], [t for t in spelled if t[:1] != b" "]


@lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    return Automaton(*pieces(path))


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_words, n_unknown, n_tokens) of every text."""

    def work(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        count = automaton(path)
        found = [text.split() for text in part.column("text").cast(pa.binary()).to_pylist()]
        totals = [sum(map(count.__getitem__, w)) for w in found]
        yield texts.record(
            SCHEMA, part.column("doc_id"), [len(w) for w in found], [t // _UNKNOWN for t in totals], [t % _UNKNOWN for t in totals]
        )

    return texts.map_texts(docs, work, "doc_id long, n_words long, n_unknown long, n_tokens long")
