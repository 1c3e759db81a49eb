"""Operator 9 against a look at every word and every block."""

import random
import re
from math import ceil

import odd

from corpusloom.llm import licenses, queries

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text):
    w = words(text)
    places, base = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                places.append(i)
                base.add(label)
    labels, score = set(base), 1.0 if places else 0.0
    for template, label, must in licenses.TEMPLATES:
        t, span = set(words(template)), len(words(template))
        for a in range(0, len(w), span):
            block = set(w[a : a + 2 * span])
            if len(block & t) >= ceil(licenses.THRESHOLD * len(t) - 1e-9) and set(must.split()) <= block:
                labels.add(label)
                score = max(score, len(block & t) / len(t))
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score)


def agree(rows, texts):
    for r in rows:
        if r["doc_id"] is not None:
            assert tuple(r)[1:] == brute(texts[r["doc_id"]]), r["doc_id"]


def test_documents(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op9_licenses(spark, sf).collect()
    assert len(rows) == len(texts) and any(r["n_base"] for r in rows)
    agree(rows, texts)


def test_changed_templates_across_blocks(spark):
    random.seed(6)
    rows = []
    for i in range(150):
        body = [f"w{random.randrange(50)}" for _ in range(random.randrange(130))]
        copy = random.choice(licenses.TEMPLATES)[0].split()
        for _ in range(i % 5):
            copy[random.randrange(len(copy))] = "other"
        at = random.randrange(len(body) + 1)
        rows.append((i, " ".join(body[:at] + copy + body[at:]).upper() + "; CC-BY mit\nlicense"))
    agree(licenses.scan(odd.documents(spark, rows)).collect(), dict(rows))


def test_odd_documents(spark):
    got = licenses.scan(odd.documents(spark, odd.ROWS)).collect()
    assert len(got) == len(odd.ROWS)
    agree(got, dict(odd.ROWS))
    assert licenses.scan(odd.empty(spark)).count() == 0


def test_plain_prose_is_no_license(spark):
    prose = [
        "The firmware was released last week under the old license of the company.",
        "This work of the general public was licensed in 3 states under the version of the license you know.",
        "He was released under the condition that the license be returned, and drove home.",
        "You may use this file, or obtain a copy of the other file at the office with the license plate.",
        "The international commons 4 work is licensed under a 0 a license.",
    ]
    named = [(t, label) for t, label, _ in licenses.TEMPLATES]
    rows = licenses.scan(odd.documents(spark, list(enumerate(prose + [t for t, _ in named])))).collect()
    got = {r["doc_id"]: r for r in rows}
    assert all(got[i]["labels"] == "" and got[i]["score"] == 0 for i in range(len(prose)))
    assert all(label in got[len(prose) + k]["labels"].split(",") for k, (_, label) in enumerate(named))
