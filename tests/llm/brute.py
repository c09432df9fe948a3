"""Plain single-process versions that the operators are compared with."""

from __future__ import annotations


def shingle_set(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    k = min(width, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def components_of(rows, width, percent):
    """{doc_id: (set size, smallest doc_id reachable)} over all pairs; rows are (doc_id, text)."""
    sets = {d: shingle_set(t, width) for d, t in rows}
    ids = sorted(sets)
    root = {d: d for d in ids}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    of = {}
    for d in ids:
        for s in sets[d]:
            of.setdefault(s, []).append(d)
    for d in ids:
        shared = {}
        for s in sets[d]:
            for other in of[s]:
                if other < d:
                    shared[other] = shared.get(other, 0) + 1
        for other, n in shared.items():
            if 100 * n >= percent * (len(sets[d]) + len(sets[other]) - n):
                a, b = sorted((find(d), find(other)))
                root[b] = a
    return {d: (len(sets[d]), find(d)) for d in ids}
