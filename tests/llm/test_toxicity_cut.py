"""Where the toxicity model calls a text toxic."""

import numpy as np
from pyspark.sql import functions as F

from tomeloom.llm import toxicity


def rows_of(rng, n, toxic):
    """Rows with a rare toxic bucket that some clean rows have too."""
    out = []
    for _ in range(n):
        y = int(rng.random() < toxic)
        ids = set(rng.integers(100, 160, 20).tolist()) | ({7} if rng.random() < (0.8 if y else 0.02) else set())
        out.append((y, np.array(sorted(ids), np.int32)))
    return out


def test_shift_pays_on_rows_that_were_not_learned():
    rng = np.random.default_rng(3)
    learned, other = rows_of(rng, 900, 0.1), rows_of(rng, 2000, 0.1)
    kept, weight, bias = toxicity.train(learned, l1=1.0)
    shift = toxicity.threshold_shift(learned, l1=1.0)
    y = np.array([t for t, _ in other])
    gain = lambda b: (lambda hit: hit[y == 1].mean() - 3 * hit[y == 0].mean())(1 / (1 + np.exp(-toxicity.logits(other, (kept, weight, b)))) >= 0.3)
    assert gain(bias + shift) >= gain(bias) - 0.05 and gain(bias + shift) > 0.55


def test_no_shift_without_both_kinds():
    rng = np.random.default_rng(1)
    assert toxicity.threshold_shift([]) == 0.0
    assert toxicity.threshold_shift([(0, x) for _, x in rows_of(rng, 30, 0.5)]) == 0.0
    assert toxicity.threshold_shift([(1, np.array([1], np.int32)), (0, np.array([2], np.int32))]) == 0.0


def test_labels_of_documents_that_are_not_here_take_no_room(spark):
    docs = spark.createDataFrame([(i, f"nice words number {i}" if i % 4 else "you awful scum") for i in range(200)], "doc_id long, text string")
    few = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    many = few.unionByName(spark.range(10_000, 60_000).select(F.col("id").alias("doc_id"), F.lit(0).alias("toxic")))
    a, b = (toxicity.fit(docs, x, F.lit(True), sample=150) for x in (few, many))
    assert a[0].tolist() == b[0].tolist() and a[1].tolist() == b[1].tolist() and a[2] == b[2]


def test_score_is_the_plain_sum(spark):
    rng = np.random.default_rng(5)
    kept = np.sort(rng.choice(1 << toxicity.BITS, 60_000, replace=False)).astype(np.int32)
    model = (kept, rng.normal(0, 1, len(kept)).astype(np.float32), -0.5)
    texts = ["a b c a b", "one", "", None, "Ü é x9 " * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    from tomeloom.llm.wordvec import words

    weight = dict(zip(kept.tolist(), model[1].tolist(), strict=True))
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        ids, _ = toxicity.grams(*words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])))
        total = sum(weight.get(x, 0.0) for x in set(ids.tolist())) - 0.5
        assert abs(got[i] - 1 / (1 + np.exp(-total))) < 1e-5
