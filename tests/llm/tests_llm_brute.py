"""Brute-force versions that several tests share."""

import re


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def shingles(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(found[i : i + 5]) for i in range(len(found) - 4)) if len(found) >= 5 else frozenset([tuple(found)] if found else [])


def components(rows):
    """(smallest doc_id reachable, number of shingles) of each (doc_id, text)."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                parent[root(i)] = root(j)
    best = {}
    for i, (doc_id, _) in enumerate(rows):
        rank = (doc_id is None, doc_id)
        best[root(i)] = min(best.get(root(i), rank), rank, key=lambda k: (k[0], k[1] or 0))
    return [(best[root(i)][1], len(sets[i])) for i in range(len(rows))]
