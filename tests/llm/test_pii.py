"""Operator 1 against the plain patterns, text by text."""

import random

import brute_pii
import odd

from corpusloom.llm import pii


def rows_of(spark, rows):
    return {r["doc_id"]: r for r in pii.report(odd.documents(spark, rows)).collect()}


def agree(got, rows):
    for i, text in rows:
        r = got[i]
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) == brute_pii.row(text), (i, text)


def test_random_texts(spark):
    random.seed(3)
    parts = list("a1.@+-% ()é😀") + [
        "12", "4111 1111 1111 1111", "1.2.3.4", "x@y.zz", "+1 (555) 123-4567", "255", "5500-0000-0000-0004", "Mr. Smith ",
    ]
    rows = [(i, "".join(random.choices(parts, k=random.randint(0, 40)))) for i in range(1500)]
    agree(rows_of(spark, rows), rows)


def test_odd_documents(spark):
    rows = [(i, t) for i, t in odd.ROWS if i is not None]
    rows += [(20, "x@y.zz " * 2000), (21, "1 " * 9000), (22, "a." * 4000 + "@" + "b.c" * 3000), (23, "1" * 30_000)]
    agree(rows_of(spark, rows), rows)
    assert pii.report(odd.empty(spark)).count() == 0
    assert pii.report(odd.documents(spark, [(None, "x@y.zz"), (None, "x@y.zz")])).count() == 2


def test_secrets_are_added_and_masked(spark):
    rows = [(i, f'call token = "{i:02d}be64439e3e49cf46b2d7c90f3602a3d0" or x{i}@y.org now') for i in range(40)]
    rows += [(100 + i, f"numbers 12345678901234567{i} here") for i in range(30)]
    docs = odd.documents(spark, rows)
    found = {r["doc_id"]: r["spans"] for r in pii.report(docs).collect()}
    assert "secret:" in found[3] and "email:" in found[3] and found[100] == ""
    masked = pii.masked(docs)
    assert masked.columns == docs.columns
    text = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert text[3] == 'call token = "[secret]" or [email] now' and text[100] == rows[40][1]


def test_no_python_in_the_plan(spark):
    plan = pii.report(odd.documents(spark, odd.ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_labelers_are_weighed():
    good, bad = (1, 1, 1, 1, -1), (0, -1, -1, 0, 0)
    prior, chances, belief = pii.reliabilities({good: 60, bad: 40, (1, -1, -1, -1, 0): 5})
    assert belief[good] > 0.95 and belief[bad] < 0.05 and 0.3 < prior < 0.8 and len(chances) == len(pii.LABELERS)


def test_addresses_with_zero_parts(spark):
    random.seed(4)
    parts = ["0", "00", "000", "0000", "1", "010", "255", "0255", "256", "0256", "99"]
    texts = ["192.168.0.1", "10.0.0.1 and 127.0.0.1.", "0.0.0.0", "000.00.0.00", "10.0.0", "0.0.0.256", "0" * 3000 + ".0.0.0"]
    texts += [" ".join(".".join(random.choices(parts, k=random.randint(3, 6))) for _ in range(3)) for _ in range(300)]
    rows = list(enumerate(texts))
    got = rows_of(spark, rows)
    agree(got, rows)
    assert [got[i]["n_ip"] for i in range(7)] == [1, 2, 1, 1, 0, 0, 1]
    masked = {r["doc_id"]: r["text"] for r in pii.masked(odd.documents(spark, rows)).collect()}
    assert masked[0] == "[ip]" and masked[1] == "[ip] and [ip]."
