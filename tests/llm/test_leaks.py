"""Operator 2 against a comparison of every diagonal."""

import math
import random
import re

import odd

from corpusloom.llm import leaks


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_substitutions_are_tolerated(spark):
    random.seed(2)
    vocabulary = [f"w{i}" for i in range(5000)]
    bench = [(i, " ".join(random.choices(vocabulary, k=40))) for i in range(30)]
    docs, planted = [], set()
    for d in range(120):
        body = random.choices(vocabulary, k=200)
        if d % 3 == 0:
            item = random.randrange(30)
            copy = words(bench[item][1])
            for p in random.sample(range(40), d % 4):
                copy[p] = "changed"
            body[50:50] = copy
            planted.add((d, item))
        docs.append((d, " ".join(body).title()))
    found = leaks.leaks(odd.documents(spark, docs), items(spark, bench)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == planted
    assert all(r["first_word"] <= 52 and r["last_word"] >= 85 and r["n_equal"] >= 34 for r in found)


def test_odd_documents(spark):
    bench = items(spark, [(1, odd.PASSAGE), (1, odd.PASSAGE), (2, None), (3, ""), (4, "one two"), (None, "alpha beta gamma"), (5, "!")])
    rows = leaks.leaks(odd.documents(spark, odd.ROWS), bench).collect()
    found = {(r["doc_id"], r["item_id"]) for r in rows}
    assert found == {(6, 1), (7, 1), (8, 1), (None, 1), (5, 4), (9, None)} and len(rows) == len(found)
    assert leaks.leaks(odd.empty(spark), bench).count() == 0
    assert leaks.leaks(odd.documents(spark, odd.ROWS), items(spark, [])).count() == 0


def test_a_large_benchmark_is_taken_in_parts(spark, monkeypatch):
    bench = items(spark, [(i, f"{odd.PASSAGE} end{i}") for i in range(8)])
    docs = odd.documents(spark, odd.ROWS)
    whole = sorted(map(tuple, leaks.leaks(docs, bench).collect()), key=str)
    monkeypatch.setattr(leaks, "MAX_SENT_BYTES", 1000)
    assert sorted(map(tuple, leaks.leaks(docs, bench).collect()), key=str) == whole and whole


def test_decontaminated(spark):
    docs = odd.documents(spark, odd.ROWS)
    kept = leaks.decontaminated(docs, items(spark, [(1, odd.PASSAGE)]))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [1, 2, 3, 4, 5, 9, 10, 11, 12]


def diagonals(doc, item, min_words, identity):
    """Whether any stretch on any diagonal has enough equal words."""
    need = max(1, min(min_words, math.ceil(identity * len(item) - 1e-9)))
    for shift in range(1 - len(item), len(doc)):
        equal = [doc[shift + j] == item[j] for j in range(len(item)) if 0 <= shift + j < len(doc)]
        for a in range(len(equal)):
            n = 0
            for b in range(a, len(equal)):
                n += equal[b]
                if n >= need and n >= identity * (b - a + 1) - 1e-9:
                    return True
    return False


def test_every_allowed_pattern_is_found(spark):
    random.seed(6)
    bench, docs = [], []
    for size in [*range(1, 28), 40]:
        bench.append((size, " ".join(f"i{size}w{j}" for j in range(size))))
        for extra in (0, 1):  # as many changed words as the rule allows, and one more
            for _ in range(8):
                copy = words(bench[-1][1])
                for p in random.sample(range(size), min(size, size - math.ceil(0.8 * size) + extra)):
                    copy[p] = "changed"
                docs.append((len(docs), " ".join(["before"] * 3 + copy + ["behind"] * 3)))
    for gap in (3, 4):  # errors at even distances leave the shortest runs
        docs += [(len(docs) + i, " ".join(w if j % gap < gap - 1 else "changed" for j, w in enumerate(words(t)))) for i, (_, t) in enumerate(bench)]
    want = {(d, i) for d, text in docs for i, t in bench if f"i{i}w" in text and diagonals(words(text), words(t), 13, 0.8)}
    found = [(r["doc_id"], r["item_id"]) for r in leaks.leaks(odd.documents(spark, docs), items(spark, bench)).collect()]
    assert set(found) == want and len(found) == len(want) and len(want) > 200


def test_families_fit_every_accepted_pattern():
    """Every pattern up to 16 words; beyond, the most changed ones up to 31, which the longer ones contain."""
    for size in range(1, 17):
        masks, need = leaks.family(size, 13, 0.8), leaks.words_needed(size, 13, 0.8)
        assert all("0" in m for m in masks) or size <= 2
        tests = [re.compile("(?=" + m.replace("0", ".") + ")") for m in masks]
        for pattern in range(1 << size):
            bits = f"{pattern:0{size}b}"
            if bits.count("1") >= need and bits.count("1") >= 0.8 * size - 1e-9:
                assert any(t.search(bits) for t in tests), (size, bits)
    masks = leaks.family(40, 13, 0.8)
    assert all("0" in m and m.count("1") == 6 for m in masks)
    random.seed(8)
    for size in range(17, 120):
        for _ in range(300):
            changed = set(random.sample(range(size), size // 5))
            bits = "".join("0" if k in changed else "1" for k in range(size))
            assert any(re.search(m.replace("0", "."), bits) for m in masks)
        for phase in range(5):
            bits = "".join("0" if k % 5 == phase else "1" for k in range(size))
            assert bits.count("1") < 0.8 * size or any(re.search(m.replace("0", "."), bits) for m in masks)
    for size, others in ((16, 3), (20, 4), (25, 5), (30, 6)):
        pattern = leaks.patterns(size, others)
        assert len(set(pattern.tolist())) == math.comb(size, others)
        left = [p for p in pattern.tolist() if not any(p >> s & m == m for m in (int(x[::-1], 2) for x in masks) for s in range(size))]
        assert not left


def test_all_is_found_by_the_masks(spark, monkeypatch):
    """Without masks nothing is found: there is no other path to a result."""
    bench, docs = items(spark, [(1, odd.PASSAGE)]), odd.documents(spark, odd.ROWS)
    assert leaks.leaks(docs, bench).count()
    monkeypatch.setattr(leaks, "family", lambda *_: ())
    assert leaks.leaks(docs, bench).count() == 0


def test_a_stem_of_many_items(spark, monkeypatch):
    stem = "which of the following statements is true about"
    bench = [(i, f"{stem} " + " ".join(f"i{i}w{j}" for j in range(20))) for i in range(3000)]
    docs = [(d, f"{stem} nothing at all " * 5) for d in range(20)] + [(20, f"so {bench[17][1]} there"), (21, bench[2999][1])]
    monkeypatch.setattr(leaks, "BLOCK_HITS", 4096)
    found = leaks.leaks(odd.documents(spark, docs), items(spark, bench)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(20, 17), (21, 2999)}
