"""Operator 5: byte-pair encoding and decoding by forced-boundary splitting.

Two bytes that stand side by side in no vocabulary token can never end up in one
token, so the place between them is a certain cut. Each pre-token is split at
its certain cuts, the fragments are encoded on their own and the ids joined.
Fragments stay short even where a pre-token is very long, and few differ, so
most come from a bounded memo.

A null or empty text has no ids and decodes to the empty text. Rows are kept as
they are: repeated rows, null ids and ties need nothing. The name of a special
token inside a text becomes that token, as the library does it.
"""

from __future__ import annotations

import json
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from corpusloom.llm import texts

# Distinct pre-tokens of at most MEMO_BYTES, and pairs of tokens, remembered by a worker at a time.
MEMO_SIZE, MEMO_BYTES = 400_000, 64
# How byte-level vocabularies cut a text into pre-tokens.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])


def byte_letters() -> dict[str, int]:
    """The printable letter that a byte-level vocabulary writes for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def remember(memo: dict, key, value) -> None:
    """Store in a memo of at most MEMO_SIZE entries."""
    if len(memo) >= MEMO_SIZE:
        memo.clear()
    memo[key] = value


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    return Coder(path)


class Coder(dict):
    """Ids of a pre-token, packed as little-endian 32-bit numbers, by its text."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        spell = lambda token: bytes(letters[c] for c in token)
        vocabulary = {spell(token): i for token, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: token for token, i in vocabulary.items()} | {i: t.encode() for t, i in self.special.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.merges = {
            (vocabulary[spell(a)], vocabulary[spell(b)]): (rank, vocabulary[spell(a + b)])
            for rank, (a, b) in enumerate(pairs)
        }
        self.ranks, self.parts = [-1] * (max(names) + 1), {}
        for pair, (rank, merged) in self.merges.items():
            if self.ranks[merged] < 0:
                self.ranks[merged], self.parts[merged] = rank, pair
        self.byte_ids = [vocabulary[bytes([b])] for b in range(256)]
        self.joinable = {pair for token in vocabulary for pair in zip(token, token[1:])}
        self.names = names
        self.pairs: dict[tuple[int, int], bool] = {}
        ordered = [names.get(i, b"") for i in range(max(names) + 1)]
        self.sizes = np.array([len(t) for t in ordered], np.int64)
        # tokens that the merge rules make of their own bytes, and the lengths to try by the first three bytes
        self.vocabulary = {t: i for t, i in vocabulary.items() if self.merged(t) == [i]}
        by_start: dict[bytes, set[int]] = {}
        for t in self.vocabulary:
            if len(t) >= 3:
                by_start.setdefault(t[:3], {1, 2}).add(len(t))
        self.lengths = {start: sorted(sizes, reverse=True) for start, sizes in by_start.items()}
        self.places = np.cumsum(self.sizes) - self.sizes
        self.letters = np.frombuffer(b"".join(ordered), np.uint8)
        self.splitter = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        # Letters and digits younger than the library's tables are plain symbols to it.
        unknown = "".join(chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn")
        young = [m.group() for m in regex.finditer(r"[\p{L}\p{N}]", unknown)]
        self.oldest_young = min((c.encode()[0] for c in young), default=256)
        self.plain = self.careful = regex.compile(_pattern(""))
        if young:
            self.careful = regex.compile(_pattern(_ranges([ord(c) for c in young])), regex.V1)

    def __missing__(self, word: str) -> bytes:
        raw = word.encode()
        ids: list[int] = []
        a, joinable = 0, self.joinable
        for b, pair in enumerate(zip(raw, raw[1:]), 1):
            if pair not in joinable:
                ids += self.fragment(raw[a:b])
                a = b
        ids += self.fragment(raw[a:])
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(raw) <= MEMO_BYTES:
            remember(self, word, packed)
        return packed

    def fragment(self, raw: bytes) -> list[int]:
        """Longest tokens first, stepping back where two neighbours would have merged otherwise.

        A row of tokens is the encoding exactly if each two neighbours are the
        encoding of their own bytes, so only pairs need the merge rules.
        """
        n, at, ids, dead = len(raw), 0, [], set()
        lengths, vocabulary, pairs, room = self.lengths, self.vocabulary, self.pairs, len(raw)
        while True:
            for size in lengths.get(raw[at : at + 3], (2, 1)):
                if size > room:
                    continue
                token = vocabulary.get(raw[at : at + size])
                if token is None or at + size in dead:
                    continue
                if ids and not (pairs[ids[-1], token] if (ids[-1], token) in pairs else self.adjoin(ids[-1], token)):
                    continue
                ids.append(token)
                at += size
                room = n - at
                break
            else:  # nothing fits here: take the last token back and try a shorter one
                dead.add(at)
                room = len(self.names[ids[-1]]) - 1
                at -= len(self.names[ids.pop()])
                continue
            if at == n:
                return ids

    def adjoin(self, a: int, b: int) -> bool:
        """Whether two tokens side by side stay apart.

        Undo their merges, the latest first, and see whether the parts that meet
        in the middle would have merged with each other before that.
        """
        known, merges, ranks, x, y, limit = None, self.merges, self.ranks, a, b, len(self.merges)
        while known is None:
            meet = merges.get((x, y))
            if meet is not None and meet[0] < limit:
                known = False
            elif ranks[x] > ranks[y]:
                limit, x = ranks[x], self.parts[x][1]
            elif ranks[y] >= 0:  # of equal ranks the left one merges first
                limit, y = ranks[y] + 1, self.parts[y][0]
            else:
                known = True
        remember(self.pairs, (a, b), known)
        return known

    def merged(self, raw: bytes) -> list[int]:
        """Merge the pair of lowest rank, the leftmost of equals, until none is left."""
        ids = [self.byte_ids[b] for b in raw]
        merges = self.merges
        while True:
            best = min(((merges[p][0], k) for k, p in enumerate(zip(ids, ids[1:])) if p in merges), default=None)
            if best is None:
                return ids
            k = best[1]
            ids[k : k + 2] = [merges[ids[k], ids[k + 1]][1]]

    def encode(self, text: str, careful: bool = True) -> bytes:
        """Packed ids of a whole text."""
        pattern, ids = self.careful if careful else self.plain, self.__getitem__
        if not self.splitter.search(text):
            return b"".join(map(ids, pattern.findall(text)))
        parts, a = [], 0
        for m in self.splitter.finditer(text):
            parts += [*map(ids, pattern.findall(text[a : m.start()])), np.array([self.special[m.group()]], "<u4").tobytes()]
            a = m.end()
        return b"".join([*parts, *map(ids, pattern.findall(text[a:]))])

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4")
        size = self.sizes[ids]
        shift = self.places[ids] - (np.cumsum(size) - size)
        raw = self.letters[np.repeat(shift, size) + np.arange(int(size.sum()))]
        return raw.tobytes().decode("utf-8", "replace")


def _ranges(codes: list[int]) -> str:
    at = [0, *(k for k in range(1, len(codes)) if codes[k] != codes[k - 1] + 1), len(codes)]
    return "".join(rf"\U{codes[a]:08x}-\U{codes[b - 1]:08x}" for a, b in zip(at, at[1:]))


def _pattern(young: str) -> str:
    if not young:
        return PRE_TOKENS
    letters, digits = rf"[\p{{L}}--[{young}]]", rf"[\p{{N}}--[{young}]]"
    other = rf"(?:[^\s\p{{L}}\p{{N}}]|[{young}])"
    return rf"'s|'t|'re|'ve|'m|'ll|'d| ?{letters}+| ?{digits}+| ?{other}+|\s+(?!\S)|\s+"


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): ids packed as little-endian unsigned 32-bit numbers."""

    def work(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        code = coder(path)
        raw, _ = texts.flat(part.column("text"))
        careful = bool(len(raw)) and int(raw.max()) >= code.oldest_young
        ids = [code.encode(text, careful) for text in part.column("text").to_pylist()]
        yield texts.record(SCHEMA, part.column("doc_id"), [len(x) // 4 for x in ids], ids, [code.decode(x) for x in ids])

    return texts.map_texts(docs, work, "doc_id long, n_tokens long, ids binary, decoded string")
