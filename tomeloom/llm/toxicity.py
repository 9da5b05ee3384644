"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the presence of a word, of two neighbouring words and of two words with one between them, hashed
into 2^18 buckets. Per-coordinate rates and L1 sparsity leave a small sorted list of weights, which tasks get
as a broadcast of bounded size. Labels are learned from at most `sample` rows and
`sample_bytes` of feature lists: those of least hash of doc_id and text, of each label its share, among documents that are there; training runs in numpy on the driver over their feature lists. Scores read whole texts. Models of two thirds of these rows,
asked about the other third, show from which logit on it pays to call a text toxic; a shift of the bias makes that the score 0.3.

Defined cases: of one doc_id on many rows each counts by itself; null and empty texts are scored by the bias alone; several labels of one doc_id count as
their maximum, null labels are skipped; without learned rows every score is
the sigmoid of -3, a clean verdict, and the bias starts there; extra columns are ignored; equal rows give equal results.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .common import batches, first_rows, stored
from .wordvec import K1, K2, K3, mix, words

BITS, PRIOR = 18, -3.0


def grams(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features and the text of each."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    ids, where = [h * K1], [text]
    for gap, key in ((1, K2), (2, K3)):
        same = text[:-gap] == text[gap:]
        ids.append(mix(h[:-gap][same] * key + h[gap:][same]))
        where.append(text[:-gap][same])
    return (np.concatenate(ids) >> np.uint64(64 - BITS)).astype(np.int32), np.concatenate(where)


def features(rows):
    import pyarrow as pa

    for part, data, ends in batches(rows):
        ids, where = grams(*words(data, ends))
        both = np.unique(where.astype(np.int64) << BITS | ids)
        cut = np.searchsorted(both >> BITS, np.arange(len(ends)))
        ids = (both & ((1 << BITS) - 1)).astype("<i4")
        yield pa.RecordBatch.from_arrays([part.column("y"), part.column("luck"), pa.array([ids[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)], pa.binary())], ["y", "luck", "ids"])


def train(rows: list[tuple[int, np.ndarray]], alpha: float = 0.5, beta: float = 1.0, l1: float = 6.0, l2: float = 0.5, epochs: int = 3, seed: int = 5) -> tuple[np.ndarray, np.ndarray, float]:
    """FTRL-proximal over (label, buckets). Returns the non-zero buckets, their weights and the bias."""
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)  # the last one is the bias, which L1 spares
    z[-1] = -PRIOR * beta / alpha  # it starts from a clean verdict, so that a few labels don't make every text toxic
    rng = np.random.default_rng(seed)

    def weights(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2)
        w[np.abs(zi) <= l1] = 0
        w[-1] = -zi[-1] / ((beta + np.sqrt(n[size])) / alpha)
        return w

    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            y, ids = rows[k]
            i = np.append(ids, size)
            w = weights(i)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            rate = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - rate * w
            n[i] += g * g
    w = weights(np.arange(size + 1))
    kept = np.flatnonzero(w[:-1]).astype(np.int32)
    return kept, w[kept].astype(np.float32), float(w[-1])


def logits(rows: list[tuple[int, np.ndarray]], model) -> np.ndarray:
    kept, weight, bias = model
    table = np.zeros(1 << BITS)
    table[kept] = weight
    return np.array([table[ids].sum() + bias for _, ids in rows])


def threshold_shift(rows: list[tuple[int, np.ndarray]], at: float = 0.3, price: float = 3.0, folds: int = 3, **options) -> float:
    """What to add to a logit so that `at` is the score from which it pays to call a text toxic: there the share of toxic rows caught less `price` times
    the share of clean rows called toxic is largest. Each row is judged by a model of the other folds. 0 without rows of both kinds in each fold."""
    y = np.array([t for t, _ in rows])
    fold = np.arange(len(rows)) % folds  # rows come in order of luck
    if not len(rows) or any(len(np.unique(y[fold == f])) < 2 for f in range(folds)):
        return 0.0
    found = np.zeros(len(rows))
    for f in range(folds):
        model = train([r for r, k in zip(rows, fold, strict=True) if k != f], **options)
        found[fold == f] = logits([r for r, k in zip(rows, fold, strict=True) if k == f], model)
    order = np.argsort(-found, kind="stable")
    gain = np.cumsum(np.where(y[order] == 1, 1 / (y == 1).sum(), -price / (y == 0).sum()))
    ends = np.append(found[order][1:] < found[order][:-1], True)  # equal ones fall together
    best = int(np.flatnonzero(ends)[np.argmax(gain[ends])])
    below = found[order][best + 1] if best + 1 < len(order) else found[order][best] - 1
    return float(np.log(at / (1 - at)) - (found[order][best] + below) / 2)


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column, sample: int = 8000, sample_bytes: int = 128 << 20, **options):
    """Learn from rows whose label meets may_learn (a condition on doc_id): at most `sample` of them and sample_bytes of features."""
    ship(docs.sparkSession)
    known = labels.where(may_learn & F.col("toxic").isNotNull()).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("y"))
    known = stored(known.join(docs.select("doc_id").distinct(), "doc_id"), "toxic-labels")  # those that meet a text: ids alone are read
    counts = {r.y: r["count"] for r in known.groupBy("y").count().collect()}  # two rows at most
    n = max(1, sum(counts.values()))
    share = F.create_map(*[F.lit(x) for y, c in (counts or {0: 1}).items() for x in (y, c / n)])[F.col("y")]
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 40))
    some = known.select("doc_id", "y", drawn.alias("drawn")).where(F.col("drawn") < min(1.0, (1.2 * sample + 100) / n) * (1 << 40))
    some = some.orderBy("drawn", "doc_id").limit(2 * sample + 200)  # a proven bound for what is broadcast
    luck = F.xxhash64("doc_id", "text", F.lit(5))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(some), "doc_id").select("y", luck.alias("luck"), "text")
    found = texts.mapInArrow(features, "y int, luck long, ids binary")
    found = first_rows(found, "y", "luck", sample, F.ceil(share * sample), F.ceil(share * sample_bytes), F.length("ids")).collect()
    rows = sorted((r.luck, r.y, bytes(r.ids)) for r in found)
    rows = [(y, np.frombuffer(ids, "<i4")) for _, y, ids in rows]
    kept, weight, bias = train(rows, **options)
    return kept, weight, bias + threshold_shift(rows, **options)


def score(docs: DataFrame, model, carry: tuple[str, ...] = ("doc_id",), name: str = "score") -> DataFrame:
    """The columns of carry, as they are in docs, and the score."""
    ship(docs.sparkSession)
    kept, weight, bias = model
    sent = docs.sparkSession.sparkContext.broadcast((kept, weight))  # at most 2^18 weights

    def rate(rows):
        import pyarrow as pa

        kept, weight = sent.value
        table = np.zeros(1 << BITS, np.float32)
        table[kept] = weight
        for part, data, ends in batches(rows):
            ids, where = grams(*words(data, ends))
            hit = np.flatnonzero(table[ids])
            both = np.unique(where[hit].astype(np.int64) << BITS | ids[hit])
            total = np.bincount(both >> BITS, table[both & ((1 << BITS) - 1)], len(ends) - 1) + bias
            out = pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(carry))), out], [*carry, name])

    kept_cols = docs.select(*[F.col(f"`{c}`") for c in carry])
    rows = kept_cols if "text" in carry else docs.select(*[F.col(f"`{c}`") for c in carry], "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept_cols.schema)
    return rows.mapInArrow(rate, f"{schema}, `{name}` double")


def keep_clean(docs: DataFrame, model, threshold: float = 0.3) -> DataFrame:
    """docs without the rows that score threshold or more; columns as they were. A text without a word stays."""
    name = "score_" + "_".join(sorted(docs.columns))  # clashes with no column
    return score(docs, model, tuple(docs.columns), name).where((F.col(f"`{name}`") < threshold) | ~F.coalesce("text", F.lit("")).rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")).select(*[F.col(f"`{c}`") for c in docs.columns])
