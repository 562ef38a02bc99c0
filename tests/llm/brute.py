"""Plain restatements of the operators' contracts, one document at a time."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, size):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) >= size:
        return {tuple(w[i: i + size]) for i in range(len(w) - size + 1)}
    return {tuple(w)} if w else set()


def components(rows, size, percent=80):
    """{doc_id: (set size, component, kept)} of (doc_id, text) rows with distinct ids."""
    sets = {d: shingles(t, size) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    p, q = sorted((find(a), find(b)))
                    parent[q] = p
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def repeated(rows, window=50):
    """{doc_id: (words, removed, sha256 of kept words)} of (doc_id, text) rows with distinct ids."""
    first, out = {}, {}
    for d, text in sorted(rows, key=lambda r: r[0]):
        w = WORD.findall(text or "")
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first.setdefault(tuple(w[i: i + window]), d) < d:
                gone[i: i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[d] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def tokens(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def greedy_tiles(a, b, least):
    """Covered tokens of b by greedy string tiling, longest common run of unmarked tokens first."""
    free_a, free_b, covered = [True] * len(a), [True] * len(b), 0
    while True:
        best, runs = least, []
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and free_a[i + k] and free_b[j + k]:
                    k += 1
                if k > best:
                    best, runs = k, [(i, j)]
                elif k == best:
                    runs.append((i, j))
        if not runs:
            return covered
        for i, j in runs:
            if all(free_a[i: i + best]) and all(free_b[j: j + best]):
                free_a[i: i + best] = free_b[j: j + best] = [False] * best
                covered += best
