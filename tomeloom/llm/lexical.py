"""Ranked lexical search over a two-level quantised index.

Documents are dealt, as tasks read them, into shards of at most SHARD_DOCS documents. A shard is one row: its terms, and for each term the places
of its documents with, on the first level, one byte each (the impact of the term in the document, rounded up to a multiple of STEP) and, on the
second, the number of occurrences. A query adds up weight * byte in each shard, which bounds every document's score from above and, a step less for each term, from below. Each
document whose upper bound reaches the kth best lower bound (of the shard, or of the exact scores that the task has by then) is scored again in integers from the second level.
Tasks give at most k documents for each query; the best of all are merged. Bounds only spare work: no document that could be among the k best is left unscored.

score = sum over the query's terms, once each, of w * ((10^9 tf) div (1000 tf + 20 m)), w = floor(1000 ln((2N + 2) / (2 df + 1))), m = 100 - 50 + (50 n N) div L, where
N counts the documents with a term, L all their terms, n the document's, df the documents that hold the term.

Defined cases: null and empty texts have no terms and are no hits (nor part of N); every row is a document, so rows that repeat are hits each; ties go to the smaller doc_id, null
last; items that agree in item_id (null too) are one item with all their terms; an item without a term, or of terms that no document has, has no rows; empty tables
give no rows; other columns are ignored. Texts of any length are read whole; a document is never parted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship
from .common import batches, stored, word_array

STEP = 3922  # 255 steps reach over the largest impact, which is under 10^6
SHARD_DOCS, SHARD_TERMS = 4096, 1 << 22
MOST_TERMS, BLOCK_ITEMS, BLOCK_TERMS = 500_000, 1024, 1 << 20
#: What stands between terms becomes a space.
SPACES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))
SHARD = "doc_ids array<long>, n array<long>, terms array<string>, df array<int>, places binary, tfs binary"


@dataclass
class Index:
    """shards: SHARD and impacts; terms: term, df; n_docs and n_terms are N and L."""

    shards: DataFrame
    terms: DataFrame
    n_docs: int
    n_terms: int


def _shards(only: list[str] | None, most_docs: int):
    """Batches of (doc_id, text) to shards; with `only`, of these terms alone."""

    def build(rows):
        import numpy as np
        import pyarrow as pa

        class Growing(dict):
            def __missing__(self, word):
                self[word] = found = len(self)
                return found

        known = None if only is None else {t.encode(): i for i, t in enumerate(only)}
        fields = pa.schema([("doc_ids", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("terms", pa.list_(pa.string())), ("df", pa.list_(pa.int32())), ("places", pa.binary()), ("tfs", pa.binary())])

        def shard(ids, sizes, met, vocab):
            where = np.repeat(np.arange(len(ids)), [len(x) for x in met])
            key, tf = np.unique(np.concatenate([*met, np.zeros(0, np.int64)]) * most_docs + where, return_counts=True)
            term, df = np.unique(key // most_docs, return_counts=True)
            names = only if known is not None else [w.decode() for w in vocab]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip([ids, sizes, [names[i] for i in term], df, (key % most_docs).astype("<u2").tobytes(), tf.astype("<u4").tobytes()], fields, strict=True)], schema=fields)

        ids, sizes, met, held, vocab = [], [], [], 0, Growing()
        for part, data, ends in batches(rows):
            text = data.tobytes().lower().translate(SPACES)
            for i, key in enumerate(part.column("doc_id").to_pylist()):
                words = text[ends[i] : ends[i + 1]].split()
                if not words:
                    continue
                mine = list(map(vocab.__getitem__, words)) if known is None else [x for x in map(known.get, words) if x is not None]
                ids.append(key)
                sizes.append(len(words))
                met.append(np.array(mine, np.int64))
                held += len(mine)
                if len(ids) == most_docs or held >= SHARD_TERMS:
                    yield shard(ids, sizes, met, vocab)
                    ids, sizes, met, held, vocab = [], [], [], 0, Growing()
        if ids:
            yield shard(ids, sizes, met, vocab)

    return build


def exact(tf, m):
    """The impact of a term that occurs tf times in a document of length figure m."""
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def build(docs: DataFrame, terms: DataFrame | None = None, shard_docs: int = SHARD_DOCS) -> Index:
    """The index of all documents. terms (term): where its queries are known, only their terms need postings; beyond MOST_TERMS of them, and by default, all have."""
    ship(docs.sparkSession)
    few = None if terms is None else [r.term for r in terms.select("term").distinct().limit(MOST_TERMS + 1).collect()]
    only = sorted(few) if few is not None and len(few) <= MOST_TERMS else None
    raw = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_shards(only, min(shard_docs, 1 << 16)), SHARD), "lexical-counts")
    total = raw.agg(F.sum(F.size("doc_ids").cast("long")), F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    n_docs, n_terms = total[0] or 0, total[1] or 0

    def impacts(rows):
        import numpy as np
        import pyarrow as pa

        for batch in rows:
            made = []
            for n, places, tfs in zip(*(batch.column(c) for c in ("n", "places", "tfs")), strict=True):
                m = 50 + 50 * np.array(n.as_py(), np.int64) * n_docs // n_terms
                value = exact(np.frombuffer(tfs.as_buffer(), "<u4").astype(np.int64), m[np.frombuffer(places.as_buffer(), "<u2")])
                made.append((-(-value // STEP)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], [*batch.schema.names, "impacts"])

    shards = stored(raw.mapInArrow(impacts, SHARD + ", impacts binary"), "lexical-index")
    each = shards.select(F.explode(F.arrays_zip("terms", "df")).alias("t")).select(F.col("t.terms").alias("term"), F.col("t.df").alias("df"))
    return Index(shards, stored(each.groupBy("term").agg(F.sum("df").alias("df")), "lexical-terms"), n_docs, n_terms)


class Shard:
    """One row of an index, as arrays."""

    def __init__(self, row: dict, n_docs: int, n_terms: int):
        import numpy as np

        self.ids = row["doc_ids"].as_py()
        self.m = 50 + 50 * np.array(row["n"].as_py(), np.int64) * n_docs // n_terms
        ends = np.cumsum([0, *row["df"].as_py()]).tolist()
        self.span = {t: (a, b) for t, a, b in zip(row["terms"].as_py(), ends, ends[1:], strict=False)}
        self.places, self.tfs = np.frombuffer(row["places"].as_buffer(), "<u2"), np.frombuffer(row["tfs"].as_buffer(), "<u4")
        self.impacts = np.frombuffer(row["impacts"].as_buffer(), np.uint8)

    def bounds(self, query: list[tuple[int, int, int]]):
        """Lower and upper bounds of all documents' scores; query: weights and spans of postings."""
        import numpy as np

        upper, less = np.zeros(len(self.m), np.int64), np.zeros(len(self.m), np.int64)
        for w, a, b in query:
            at = self.places[a:b]
            upper[at] += w * self.impacts[a:b].astype(np.int64)
            less[at] += w
        return (upper - less) * STEP, upper * STEP

    def scores(self, query: list[tuple[int, int, int]], wanted):
        """Exact scores of the documents that the mask wanted names."""
        import numpy as np

        score = np.zeros(len(self.m), np.int64)
        for w, a, b in query:
            mine = np.flatnonzero(wanted[self.places[a:b]])
            at = self.places[a:b][mine]
            score[at] += w * exact(self.tfs[a:b][mine].astype(np.int64), self.m[at])
        return score


def _ranked(queries: list[tuple[int, list[str], list[int]]], k: int, n_docs: int, n_terms: int):
    """Batches of an index's rows to the k best documents of each query among them."""

    def run(rows):
        import numpy as np
        import pyarrow as pa

        best: dict[int, list] = {}  # of each query: (-score, no id, id)
        for batch in rows:
            for i in range(batch.num_rows):
                shard = Shard({c: batch.column(c)[i] for c in batch.schema.names}, n_docs, n_terms)
                for q, terms, weights in queries:
                    query = [(w, *shard.span[t]) for t, w in zip(terms, weights, strict=True) if t in shard.span]
                    if not query:
                        continue
                    lower, upper = shard.bounds(query)
                    have = best.get(q, [])
                    low = np.concatenate([lower, [-s for s, _, _ in have]])
                    kth = max(1, int(np.partition(low, len(low) - k)[len(low) - k])) if len(low) >= k else 1
                    wanted = upper >= kth
                    where = np.flatnonzero(wanted)
                    if not len(where):
                        continue
                    score = shard.scores(query, wanted)[where]
                    new = [(-s, shard.ids[p] is None, shard.ids[p] or 0) for s, p in zip(score.tolist(), where.tolist(), strict=True) if s > 0]
                    best[q] = sorted([*have, *new])[:k]
        found = [(q, None if none else d, -s) for q, rows_ in best.items() for s, none, d in rows_]
        q, d, s = zip(*found, strict=True) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(d, pa.int64()), pa.array(s, pa.int64())], ["q", "doc_id", "score"])

    return run


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term: once each."""
    return items.select(F.col("item_id").cast("long").alias("item_id"), F.explode(word_array(F.col("text"))).alias("term")).distinct()


def search(index: Index, asked: DataFrame, k: int = 50) -> DataFrame:
    """item_id, rank, doc_id, score of the k best documents of each item of asked (item_id, term).

    Items are asked in blocks of about BLOCK_ITEMS items and BLOCK_TERMS terms, each one pass over the index with that block sent along.
    """
    size = asked.agg(F.count_distinct(F.coalesce(F.col("item_id").cast("string"), F.lit(""))), F.count("*")).first()
    blocks = max(1, -(-size[0] // BLOCK_ITEMS), -(-size[1] // BLOCK_TERMS))
    ratio = F.lit(2.0 * index.n_docs + 2) / (2 * F.col("df") + 1)
    weighed = asked.join(index.terms, "term").select("item_id", "term", F.floor(1000 * F.log(ratio)).alias("w")).where("w > 0")
    weighed = stored(weighed.withColumn("b", F.pmod(F.xxhash64("item_id"), F.lit(blocks))), "lexical-queries")
    parts = []
    for b in range(blocks):
        rows = weighed.where(F.col("b") == b).groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct("term", "w"))).alias("t")).collect()
        queries = [(i, [x.term for x in r.t], [x.w for x in r.t]) for i, r in enumerate(rows)]
        names = asked.sparkSession.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], "q int, item_id long")
        found = index.shards.mapInArrow(_ranked(queries, k, index.n_docs, index.n_terms), "q int, doc_id long, score long")
        best = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        top = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        parts.append(top.join(F.broadcast(names), "q").select("item_id", "rank", "doc_id", "score"))
    if len(parts) == 1:
        return parts[0]
    out = stored(parts[0], "lexical-hits")
    for part in parts[1:]:
        out = out.unionByName(stored(part, "lexical-hits"))
    return out


def rank(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """search() of all items over an index of docs with their terms."""
    asked = stored(item_terms(items), "lexical-terms-asked")
    return search(build(docs, asked), asked, k)
