"""Exact top-k search by exhaustive term-at-a-time accumulation.

Vectors are quantised to integers; their non-zero components are the terms. Queries and candidates are
dealt into blocks of bounded size (a candidate is sent once for each query block, a query once for each candidate block); each
(query block, candidate block) is one task-sized unit. In a unit
the candidates become postings (term -> positions, weights), each query scatters its weighted postings
into one dense score array, and a partition selection keeps its k best. The units' lists are then merged.

Defined cases: null vectors, vectors with null, NaN or infinite components and null ids take no part;
rows equal in id and vector count once; of an id with several vectors, as a query each one's best are listed under that id, together
the k best; a query's own id is never its candidate; a missing component
counts as zero, so lengths may differ; ties go to the smaller id; fewer candidates give fewer rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship
from .common import stored


def quantised(vectors: DataFrame, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, q): floor(scale * x) of each component, for rows that take part."""
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    v = v.where(F.col("id").isNotNull() & F.col("v").isNotNull() & F.forall("v", good))
    return v.select("id", F.transform("v", lambda x: F.floor(x * F.lit(float(scale)))).alias("q"))


def accumulate(cands: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best candidates of each query in one unit."""
    cands = cands.sort_values("id", kind="stable")
    ids = cands["id"].to_numpy()
    sizes = cands["q"].map(len).to_numpy()
    term = np.concatenate([np.arange(s) for s in sizes]) if len(sizes) else np.zeros(0, int)
    pos, weight = np.repeat(np.arange(len(ids)), sizes), np.concatenate([*cands["q"], np.zeros(0, np.int64)]).astype(np.int64)
    order = np.argsort(term, kind="stable")
    order = order[weight[order] != 0]
    cut = np.searchsorted(term[order], np.arange((sizes.max() if len(sizes) else 0) + 1))
    postings = [(pos[order[a:b]], weight[order[a:b]]) for a, b in zip(cut, cut[1:], strict=False)]
    out = []
    for query, q in zip(queries["id"], queries["q"], strict=True):
        score = np.zeros(len(ids), np.int64)
        for t in np.flatnonzero(q[: len(postings)]):
            where, w = postings[t]
            if len(where) == len(ids):
                score += int(q[t]) * w
            else:
                score[where] += int(q[t]) * w
        own = np.flatnonzero(ids != query)
        s = score[own]
        if len(s) > k:
            kth = np.partition(s, len(s) - k)[len(s) - k]
            above = np.flatnonzero(s > kth)
            best = np.concatenate([above, np.flatnonzero(s == kth)[: k - len(above)]])  # ids ascend: ties to the smaller
        else:
            best = np.arange(len(s))
        out.append(pd.DataFrame({"query_id": np.full(len(best), query), "vec_id": ids[own[best]], "score": s[best]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding", query_block: int = 16384, cand_block: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score. is_query: a condition on the column `id`. Blocks bound a unit's memory at any input size."""
    ship(vectors.sparkSession)
    v = stored(quantised(vectors, scale, id_col, vec_col).dropDuplicates(["id", "q"]), "topk-vectors")
    n, nq = v.agg(F.count("*"), F.count_if(is_query)).first()
    c_blocks, q_blocks = max(1, -(-n // cand_block)), max(1, -(-nq // query_block))
    units = c_blocks * q_blocks
    units = max(min(units, 4096), units // 16)  # tasks: from one to sixteen units each, whatever the input's size
    block = lambda blocks, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    cands = v.select("id", "q", block(c_blocks, 1).alias("c"), every(q_blocks).alias("b"))
    queries = v.where(is_query).select("id", "q", block(q_blocks, 2).alias("b"), every(c_blocks).alias("c"))
    pairs = cands.repartition(units, "b", "c").groupBy("b", "c").cogroup(queries.repartition(units, "b", "c").groupBy("b", "c"))
    found = pairs.applyInPandas(lambda x, y: accumulate(x, y, k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
