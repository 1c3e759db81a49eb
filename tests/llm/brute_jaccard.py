"""Components of similar texts, pair by pair."""

import re


def shingles(text, k):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def components(docs, k, percent):
    """{doc_id: (set size, smallest reachable id)}"""
    sets = {i: shingles(t, k) for i, t in docs.items()}
    parent = {i: i for i in docs}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    lists = {}
    for i, s in sets.items():
        for x in s:
            lists.setdefault(x, []).append(i)
    for i, s in sets.items():
        met = {}
        for x in s:
            for j in lists[x]:
                if j < i and 100 * min(len(s), len(sets[j])) >= percent * max(len(s), len(sets[j])):
                    met[j] = met.get(j, 0) + 1
        for j, common in met.items():
            if 100 * common >= percent * (len(s) + len(sets[j]) - common):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in docs}
