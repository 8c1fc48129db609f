"""Plain single-process versions of the operators, for small inputs."""

import itertools


def words(text):
    return (text or "").encode().lower().split()


def shingle_set(text, k=5):
    w = words(text)
    if not w:
        return frozenset()
    if len(w) < k:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def jaccard_components(rows):
    """{doc_id: (n_shingles, component)} for (doc_id, text) rows with distinct ids."""
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    index = {}
    for i, s in sets.items():
        for g in s:
            index.setdefault(g, []).append(i)
    pairs = {p for ids in index.values() for p in itertools.combinations(sorted(ids), 2)}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


def containments(items, rows):
    """{(doc_id, item_id): (shared, size)} of items with 3/4 of their shingles in a text."""
    out = {}
    for d, t in rows:
        s = shingle_set(t)
        for i, x in items:
            q = shingle_set(x)
            if q and 4 * len(q & s) >= 3 * len(q):
                out[d, i] = (len(q & s), len(q))
    return out
