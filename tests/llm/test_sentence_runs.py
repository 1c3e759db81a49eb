"""Operator 10 against every run of enough sentences and words, not only the shortest."""

import random

import odd
import test_sentences

from corpusloom.llm import sentences


def runs(text):
    """All spans: each run of lines of sentences, one per line here, of two and 25 words or one of 25 words."""
    lines, out, at = text.split("\n"), [], [0]
    for x in lines:
        at.append(at[-1] + len(x) + 1)
    for a in range(len(lines)):
        for b in range(a + 1, len(lines) + 1):
            words = tuple(" ".join(lines[a:b]).split())
            if len(words) >= sentences.MIN_WORDS:
                out.append((words, at[a], at[b] - 1))
    return out


def brute(docs):
    first, cut = {}, {}
    for i, text in sorted(docs.items()):
        for words, a, b in sorted(runs(text), key=lambda x: x[1:]):
            if first.setdefault(words, (i, a)) != (i, a):
                cut.setdefault(i, []).append((a, b))
    out = {}
    for i, mine in cut.items():
        united = []
        for a, b in sorted(mine):
            if united and a <= united[-1][1] + 1:
                united[-1][1] = max(b, united[-1][1])
            else:
                united.append([a, b])
        out[i] = [tuple(x) for x in united]
    return out


def test_every_repeated_run_is_covered(spark):
    random.seed(11)
    line = lambda n: " ".join(f"w{random.randrange(5000)}" for _ in range(n)) + "."
    shared = [[line(random.choice([1, 2, 3, 5, 12, 15, 30])) for _ in range(random.randint(2, 7))] for _ in range(30)]
    shared += [[line(30), line(3), line(3)], [line(15), line(3), line(15)], [line(3), line(3), line(30)]]
    docs = {}
    for i in range(200):
        body = [line(random.randint(1, 30)) for _ in range(random.randint(0, 5))]
        at = random.randint(0, len(body))
        docs[i] = "\n".join(body[:at] + shared[i % len(shared)] + body[at:])
    docs[1000] = docs[30]
    want = brute(docs)
    assert test_sentences.got(odd.documents(spark, list(docs.items()))) == want and len(want) > 100
