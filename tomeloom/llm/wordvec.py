"""Vectorised words, word hashes and shingles over a buffer of UTF-8 texts (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np

LOW = np.arange(256, dtype=np.uint8)
LOW[65:91] += 32
IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True
MASK = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [2**64 - 1], np.uint64)
K1, K2, K3 = (np.uint64(x) for x in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x9E3779B97F4A7C15))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(33))
    x = x * K1
    x ^= x >> np.uint64(33)
    x *= K2
    x ^= x >> np.uint64(33)
    return x


def words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and for each text the index of its first word (one more at the end)."""
    low = np.zeros(len(data) + 16, np.uint8)
    low[: len(data)] = LOW[data]
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = IS_WORD[low[: len(data)]]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = ends[(ends > 0) & (ends < len(data))]  # a word never goes on in the next text
    first[edges] |= inside[edges]
    last[edges - 1] |= inside[edges - 1]
    start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    size = stop - start
    eight = np.ndarray((len(low) - 7,), "<u8", low, 0, (1,))
    h = mix((eight[start] & MASK[np.minimum(size, 8)]) + size.astype(np.uint64) * K3)
    rest, done = np.flatnonzero(size > 8), 8
    while len(rest):
        h[rest] = mix(h[rest] ^ (eight[start[rest] + done] & MASK[np.minimum(size[rest] - done, 8)])) + K3
        done += 8
        rest = rest[size[rest] > done]
    return h, np.searchsorted(start, ends)


def shingles(h: np.ndarray, first: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words and the text of each; a text of fewer words, but not none, has one shingle of them all."""
    count = np.diff(first)
    text = np.repeat(np.arange(len(count)), count)
    out = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for i in range(n):
        out = mix(out * K3 + h[i : len(h) - n + 1 + i]) if i else mix(h[: len(out)].copy())
    keep = text[: len(out)] == text[n - 1 :][: len(out)] if len(out) else np.zeros(0, bool)
    out, where = out[keep], text[: len(keep)][keep]
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        alone = mix(h[first[short]].copy())
        for i in range(1, n):
            more = np.flatnonzero(count[short] > i)
            alone[more] = mix(alone[more] * K3 + h[first[short[more]] + i])
        alone += count[short].astype(np.uint64)
        out, where = np.concatenate([out, alone]), np.concatenate([where, short])
        order = np.argsort(where, kind="stable")
        out, where = out[order], where[order]
    return out, where
