"""Operators 5 and 7 against the library and against longest matching piece by piece."""

import hashlib
import random

import numpy as np
import odd
import public_tokenizers
from tokenizers import Tokenizer

from corpusloom.llm import bpe, queries, wordpiece

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_random_texts_as_the_library():
    library, coder = Tokenizer.from_file(PATH), bpe.Coder(PATH)
    random.seed(1)
    parts = ["a", "b", "the", " ", "  ", "\n", "\t", "é", "漢", "😀", "'s", "'", "1", "23", "!", "<|endoftext|>", "　", "\x1c", "\x85", "ing", "er"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 60))) for _ in range(3000)]
    texts += ["a" * 5000, "ab" * 3000 + "!" * 3000 + " " * 3000, "".join(map(chr, range(0x20, 0x3000)))]
    texts += [f"a{chr(c)}1{chr(c)} {chr(c)}" for c in (*range(0x530, 0x600), 0x1C89, 0x10D40, 0x16D40, 0x1E5D0, 0x2EBF0, 0x3FFFD)]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        packed = coder.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == want, text[:80]
        assert coder.decode(packed) == library.decode(want, skip_special_tokens=False)


def test_certain_cuts_lie_in_no_token():
    coder = bpe.Coder(PATH)
    cut = next((a, b) for a in range(256) for b in range(256) if (a, b) not in coder.joinable)
    assert not any(bytes(cut) in token for token in coder.vocabulary)


def test_encoded_documents(spark):
    library = Tokenizer.from_file(PATH)
    got = bpe.encode_documents(odd.documents(spark, odd.ROWS), PATH).collect()
    assert len(got) == len(odd.ROWS)
    texts = dict(odd.ROWS)
    for r in got:
        if r["doc_id"] is not None:
            ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
            assert r["n_tokens"] == len(ids) and r["ids"] == np.array(ids, "<u4").tobytes()
            assert r["decoded"] == (texts[r["doc_id"]] or "")
    assert bpe.encode_documents(odd.empty(spark), PATH).count() == 0


def test_query_digests(spark):
    library = Tokenizer.from_file(PATH)
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op5_bpe(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def longest(word, start, rest):
    """Number of pieces by trying the longest piece at each place, 0 if none fits."""
    at, n, pieces = 0, 0, start
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return 0
        at, n, pieces = end, n + 1, rest
    return n


def test_automaton():
    random.seed(4)
    for _ in range(60):
        make = lambda n: {bytes(random.choices(b"abc", k=random.randint(1, 5))) for _ in range(n)}  # noqa: E731, B023
        start, rest = make(6), make(8)
        count = wordpiece.Automaton(start, rest)
        for _ in range(200):
            word = bytes(random.choices(b"abc", k=random.randint(1, 14)))
            n = longest(word, start, rest)
            assert count.count(word) == (n or wordpiece._UNKNOWN + 1), (word, start, rest)


def test_token_counts(spark):
    start, rest = map(set, wordpiece.pieces(PATH))
    for sf in ("/root/testdata/sf0.001",):
        texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
        for r in queries.op7_token_counts(spark, sf).collect():
            words = texts[r["doc_id"]].encode().split()
            counts = [longest(w, start, rest) for w in words] if len(words) < 300 else None
            assert r["n_words"] == len(words)
            assert counts is None or (r["n_tokens"], r["n_unknown"]) == (sum(n or 1 for n in counts), counts.count(0))
    rows = wordpiece.token_counts(odd.documents(spark, odd.ROWS), PATH).collect()
    assert len(rows) == len(odd.ROWS)
    assert {r["doc_id"]: r["n_words"] for r in rows if r["doc_id"] in (1, 2, 3, 5, 9)} == {1: 0, 2: 0, 3: 0, 5: 2, 9: 90_000}
    assert wordpiece.token_counts(odd.empty(spark), PATH).count() == 0
