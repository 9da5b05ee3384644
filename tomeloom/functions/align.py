"""Pieces that a model copied from a text, placed exactly in it by alignment.

White space is left out on both sides. Runs of GRAM characters that are unique on both sides, in an increasing chain, are
anchors; between two anchors the edit distance is computed in a band that widens until the distance proves it wide enough. Where a boundary between
pieces falls into such a gap, it goes to the place at which the cost before and the cost after it sum to the least (the first
of equals), so nothing is traced back and memory grows with the width of the band.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

GRAM, BAND = 12, 32
FAR = 1 << 28


def anchors(a: str, b: str) -> list[tuple[int, int, int]]:
    """(start in a, start in b, length) of common runs that rise in both: the longest chain of grams that occur once in each."""
    from bisect import bisect_left

    def once(t):
        at = {}
        for i in range(len(t) - GRAM + 1):
            g = t[i : i + GRAM]
            at[g] = -1 if g in at else i
        return at

    mine, other = once(a), once(b)
    pairs = [(i, other[g]) for g, i in mine.items() if i >= 0 and other.get(g, -1) >= 0]
    ends, last, before = [], [], []  # least end of a chain of each length, its pair, and each pair's one before
    for n, (_, j) in enumerate(pairs):
        k = bisect_left(ends, j)
        before.append(last[k - 1] if k else -1)
        if k == len(ends):
            ends.append(j)
            last.append(n)
        else:
            ends[k], last[k] = j, n
    chain, n = [], last[-1] if last else -1
    while n >= 0:
        chain.append(pairs[n])
        n = before[n]
    runs = []
    for i, j in reversed(chain):
        x, y, n = runs[-1] if runs else (-1, -1, 0)
        if runs and i - x == j - y and i <= x + n:
            runs[-1] = (x, y, i + GRAM - x)
        elif i >= x + n and j >= y + n:
            runs.append((i, j, GRAM))
    return runs


def costs(a: np.ndarray, b: np.ndarray, rows: list[int], band: int) -> tuple[dict[int, np.ndarray], int]:
    """Edit distances of a[:i] from each b[:j] for i in rows, inside a band about the diagonals that join both ends; and that of a from b."""
    n, m = len(a), len(b)
    low = min(0, m - n) - band
    width = max(0, m - n) + band - low + 1
    ramp = np.arange(width)
    padded = np.concatenate([np.full(n + width, -1), b, np.full(n + width, -1)])  # cell t of row i is column i + low + t
    at = lambda i: i + low + ramp
    row = np.where((at(0) >= 0) & (at(0) <= m), at(0), FAR)
    kept = {}
    for i in range(n + 1):
        if i:
            start = n + width + i + low - 1
            new = row + (padded[start : start + width] != a[i - 1])
            new[:-1] = np.minimum(new[:-1], row[1:] + 1)
            cols = at(i)
            new[(cols < 0) | (cols > m)] = FAR
            row = np.minimum(np.minimum.accumulate(new - ramp) + ramp, FAR)
            row[cols > m] = FAR
        if i in rows:
            full = np.full(m + 1, FAR)
            cols = at(i)
            ok = (cols >= 0) & (cols <= m)
            full[cols[ok]] = row[ok]
            kept[i] = full
    return kept, int(row[m - n - low])


def places(a: np.ndarray, b: np.ndarray, cuts: list[int]) -> tuple[list[int], int]:
    """Where each of the ascending cuts of a falls in b, on an alignment of least edit distance, and that distance."""
    if not len(a) or not len(b):
        return [0 if c < len(a) or not len(a) else len(b) for c in cuts], max(len(a), len(b))
    band = BAND
    while True:
        ahead, total = costs(a, b, cuts, band)
        if total <= abs(len(a) - len(b)) + 2 * band or band >= max(len(a), len(b)):
            break
        band *= 2
    if not cuts:
        return [], total
    behind, _ = costs(a[::-1], b[::-1], [len(a) - c for c in cuts], band)
    found = [int(np.argmin(ahead[c] + behind[len(a) - c][::-1])) for c in cuts]
    return np.maximum.accumulate(found).tolist(), total


def solid(t: str) -> tuple[str, list[int]]:
    """t without white space, and each character's place."""
    at = [i for i, c in enumerate(t) if not c.isspace()]
    return "".join(t[i] for i in at), at


def spans(text: str, pieces: list[str]) -> list[tuple[int, int]] | None:
    """Gapless spans of text, one for each piece in order (empty ones for pieces that have no part of it); None if they are no copy of it.

    What no piece has belongs to the piece after it, at the end to the last one; white space to the piece before it. They are no copy if, besides what
    they leave out, over half of their characters differ.
    """
    copy, ends = "", []
    for p in pieces:
        copy += solid(p)[0]
        ends.append(len(copy))
    body, at = solid(text)
    if not copy or not body:
        return None
    cuts, runs = ends[:-1], anchors(copy, body)
    code = lambda t: np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    a, b = code(copy), code(body)
    found, cost, i, j = {}, 0, 0, 0
    for x, y, n in [*runs, (len(a), len(b), 0)]:
        inside = sorted({c for c in cuts if i <= c <= x})
        there, d = places(a[i:x], b[j:y], [c - i for c in inside])
        found.update((c, j + t) for c, t in zip(inside, there, strict=True))
        found.update((c, y + c - x) for c in cuts if x < c < x + n)
        cost += d
        i, j = x + n, y + n
    if cost - max(0, len(b) - len(a)) > len(a) / 2:
        return None
    starts = [at[found[c]] if 0 < found[c] < len(at) else 0 if found[c] <= 0 else len(text) for c in cuts]
    edges = np.maximum.accumulate([0, *starts, len(text)]).tolist()
    return list(zip(edges, edges[1:]))


def aligned_pieces(text: Column, said: Column, kind: str) -> Column:
    """Pieces (text, start_char, end_char) of text as said (an array of strings) cuts it: the text's own characters, gapless. Null if said is empty, null or no copy."""

    @F.arrow_udf(kind)
    def placed(texts, said):
        from tomeloom.functions.align import aligned_lists
        from tomeloom.operators.chunking import by_slices

        return by_slices(aligned_lists, texts, said)

    return placed(text, said)


def aligned_lists(texts: list, said: list):
    """aligned_pieces() of lists, as an Arrow array."""
    from tomeloom.operators.chunking import piece_lists

    out = []
    for t, parts in zip(texts, said, strict=True):
        found = spans(t, parts) if t and parts else None
        out.append(found and [(t[i:j], i, j) for i, j in found if j > i])
    return piece_lists(out)
