"""Plain restatements of the operators, for small inputs."""

import re
from collections import Counter

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, n=5):
    w = words(text)
    return Counter(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else Counter()


def weighted_jaccard(a, b):
    both, all_ = sum((a & b).values()), sum((a | b).values())
    return both / all_ if all_ else 0.0


def near_classes(docs, threshold=0.8):
    """doc_id -> class id of (doc_id, text) rows."""
    parent = {d: d for d, _ in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sh = {d: shingles(t) for d, t in docs}
    for i, (a, ta) in enumerate(docs):
        for b, tb in docs[:i]:
            if ta is not None and tb is not None and (ta == tb or weighted_jaccard(sh[a], sh[b]) >= threshold):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {d: find(d) for d, _ in docs}


def contaminated(text, items, n=10):
    """Hit word places and items of a text; items: (item_id, text)."""
    w, hit, found = words(text), set(), set()
    for item, t in items:
        v = words(t)
        size = min(n, len(v))
        windows = {tuple(v[i : i + size]) for i in range(len(v) - size + 1)} if size and item is not None else set()
        for i in range(len(w) - size + 1):
            if tuple(w[i : i + size]) in windows:
                hit.update(range(i, i + size))
                found.add(str(item))
    return hit, sorted(found)
