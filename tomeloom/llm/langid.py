"""Language identification: averaged hashed subword embeddings and a linear softmax.

Subwords are the UTF-8 byte 3- and 4-grams of a lower-cased word with its edges, hashed into buckets. A
text's vector is the mean of its subwords' embeddings; a linear softmax gives the class. Both are trained
by stochastic gradient descent in numpy on the driver, on at most `per_lang` rows and `per_lang_bytes` of features for each of the
`most_langs` most common languages: those of least hash of doc_id and text. None of these bounds grows with the data. A fifth of the sample is
held back to fit the softmax temperature and the rejection threshold: `accepted` is false for a score
under which the held-back rows fall short of `precision`.

Prediction reads whole texts in Arrow batches; the model is one bucket x language table of fixed size.

Defined cases: null texts and texts without a letter give `und`, score 0, not accepted; with no
labelled row every text gives `und`; a language beyond the most_langs most common ones is never predicted; of one doc_id on many rows each counts by itself; extra columns are ignored; equal rows give equal results.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .common import batches, first_rows
from .wordvec import LOW

BITS = 15
LETTER = np.zeros(256, bool)
LETTER[97:123] = LETTER[128:] = True
FOLD = np.where(LETTER[LOW], LOW, 32).astype(np.uint8)  # what is no letter is an edge


def subwords(data: np.ndarray, ends: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each n: buckets of all subwords in order, and for each text the index of its first (one more at the end)."""
    n_texts = len(ends) - 1
    b = np.full(len(data) + n_texts + 4, 32, np.uint32)  # an edge before each text, and some at the end
    b[np.arange(len(data)) + np.repeat(np.arange(1, n_texts + 1), np.diff(ends))] = FOLD[data]
    at = ends + np.arange(n_texts + 1)
    inner, out = b != 32, []
    for n in (3, 4):
        m = len(b) - n
        ok = inner[1 : m + 1].copy()
        for i in range(2, n - 1):
            ok &= inner[i : m + i]
        h = b[:m].copy()
        for i in range(1, n):
            h *= np.uint32(0x01000193)
            h ^= b[i : m + i]
        h *= np.uint32(0x9E3779B1)
        pos = np.flatnonzero(ok)
        out.append(((h[pos] >> np.uint32(32 - BITS)).astype(np.int32), np.searchsorted(pos, at)))
    return out


def features(rows):
    """(lang, luck, buckets, weights) of each text; buckets and weights, which add up to 1, as bytes."""
    import pyarrow as pa

    for part, data, ends in batches(rows):
        grams = subwords(data, ends)
        ids, ws = [], []
        for i in range(len(ends) - 1):
            u, c = np.unique(np.concatenate([g[f[i] : f[i + 1]] for g, f in grams]), return_counts=True)
            ids.append(u.astype("<i4").tobytes())
            ws.append((c / max(1, c.sum())).astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays([part.column("lang"), part.column("luck"), pa.array(ids, pa.binary()), pa.array(ws, pa.binary())], ["lang", "luck", "ids", "ws"])


def train(rows: list, langs: list[str], dim: int = 16, epochs: int = 6, rate: float = 0.5, precision: float = 0.99, seed: int = 7) -> dict:
    """rows: (lang, ids, ws) as bytes. Returns the bucket x language score table, temperature and threshold."""
    rng = np.random.default_rng(seed)
    x = [(langs.index(a), np.frombuffer(i, "<i4"), np.frombuffer(w, "<f4")) for a, i, w in rows if len(i)]
    x = [x[i] for i in rng.permutation(len(x))]
    held, fit = x[: len(x) // 5], x[len(x) // 5 :]
    emb = rng.normal(0, 0.1, (1 << BITS, dim)).astype(np.float32)
    out = np.zeros((dim, len(langs)), np.float32)
    out[:] = rng.normal(0, 0.1, out.shape)
    steps, step = epochs * len(fit), 0
    for _ in range(epochs):
        for i in rng.permutation(len(fit)):
            y, ids, w = fit[i]
            lr, step = rate * (1 - step / steps), step + 1
            hidden = w @ emb[ids]
            z = hidden @ out
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = out @ p
            out -= lr * np.outer(hidden, p)
            emb[ids] -= (lr * min(50.0, 1 / float((w * w).sum())) * w)[:, None] * back  # as fast for long texts as for short ones
    table = emb @ out
    temperature, threshold = 1.0, 0.0
    if held:
        z, y = np.array([w @ table[i] for _, i, w in held]), np.array([a for a, _, _ in held])

        def soft(t):
            e = np.exp((z - z.max(1, keepdims=True)) / t)
            return e / e.sum(1, keepdims=True)

        temperature = min(np.geomspace(0.05, 20, 60), key=lambda t: -np.log(np.maximum(soft(t)[np.arange(len(y)), y], 1e-12)).sum())
        p = soft(temperature)
        order = np.argsort(-p.max(1))
        right = np.cumsum((p.argmax(1) == y)[order]) / np.arange(1, len(y) + 1)
        good = np.flatnonzero(right >= precision)
        threshold = float(p.max(1)[order[good[-1]]]) if len(good) else 1.0
    return {"langs": langs, "table": np.ascontiguousarray(table.T), "temperature": float(temperature), "threshold": threshold}


def fit(docs: DataFrame, may_learn: Column, per_lang: int = 1200, per_lang_bytes: int = 16 << 20, most_langs: int = 64, **options) -> dict:
    """Learn from rows that meet may_learn and have a lang: for each of most_langs languages, per_lang rows and per_lang_bytes of features at most."""
    ship(docs.sparkSession)
    rows = docs.where(may_learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = dict(rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_langs).collect())
    if not counts:
        return {"langs": [], "table": None, "temperature": 1.0, "threshold": 1.0}
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, (1.2 * per_lang + 100) / n))])  # a few more, then the exact limit
    luck = F.pmod(F.xxhash64("doc_id", "text", F.lit(11)), F.lit(1 << 40))
    near = rows.select("lang", "text", luck.alias("luck")).where(F.col("luck") < share[F.col("lang")] * float(1 << 40))
    found = near.mapInArrow(features, "lang string, luck long, ids binary, ws binary")
    found = first_rows(found, "lang", "luck", per_lang, F.lit(per_lang), F.lit(per_lang_bytes), F.length("ids") + F.length("ws")).collect()
    return train(sorted((r.lang, bytes(r.ids), bytes(r.ws)) for r in found), sorted(counts), **options)


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang_pred, score and accepted of every row."""
    ship(docs.sparkSession)
    langs, table, temperature, threshold = (model[k] for k in ("langs", "table", "temperature", "threshold"))
    sent = docs.sparkSession.sparkContext.broadcast(table)  # 2^15 buckets x at most most_langs languages

    def predict(rows):
        import pyarrow as pa

        table = sent.value
        for part, data, ends in batches(rows):
            n = len(ends) - 1
            total, count = np.zeros((len(langs), n)), np.zeros(n)
            for ids, first in subwords(data, ends):
                count += np.diff(first)
                for c in range(len(langs)):
                    run = np.concatenate([[0.0], np.cumsum(table[c][ids], dtype=np.float64)])
                    total[c] += run[first[1:]] - run[first[:-1]]
            pred, score, sure = np.full(n, "und", object), np.zeros(n), np.zeros(n, bool)
            if langs:
                z = total / np.maximum(count, 1) / temperature
                p = np.exp(z - z.max(0))
                p /= p.sum(0)
                some = part.column("letters").to_numpy(zero_copy_only=False)
                pred[some] = np.array(langs, object)[p.argmax(0)][some]
                score[some] = p.max(0)[some]
                sure = some & (score >= threshold)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(pred, pa.string()), pa.array(score), pa.array(sure)], ["doc_id", "lang_pred", "score", "accepted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    return rows.mapInArrow(predict, "doc_id long, lang_pred string, score double, accepted boolean")
