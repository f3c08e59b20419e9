"""Plain versions of what the operators compute, for small inputs."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, n):
    w = words(lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) or frozenset([tuple(w)])


def components(rows, n, percent):
    """{doc_id: component} over all pairs of (doc_id, text) rows."""
    sets = [(d, shingles(t, n)) for d, t in rows if d is not None]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {d: find(d) for d in root}


def removed(rows, n=13):
    """For each row the set of word positions that a smaller doc_id repeats."""
    first = {}
    for d, t in rows:
        if d is not None:
            w = words(t)
            for i in range(len(w) - n + 1):
                k = tuple(w[i:i + n])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, t in rows:
        w = words(t)
        gone = set()
        if d is not None:
            for i in range(len(w) - n + 1):
                if first[tuple(w[i:i + n])] < d:
                    gone.update(range(i, i + n))
        out.append(gone)
    return out
