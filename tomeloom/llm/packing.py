"""Best-fit packing by sum of squares.

Documents become token ids plus an end id; longer ones are cut into pieces of `capacity`, with a shorter first
piece. Full pieces are sequences of their own. The others are dealt by hash into groups of about GROUP pieces
and packed in each group, longest first: with N(g) open sequences that have a gap of g, each piece goes where
the sum of all N(g)^2 becomes least (a full sequence has no gap; ties go to the smaller gap; a new sequence is opened
only where none fits, which takes a few percent fewer of them here than the online rule that may open one
any time). A group wastes a fraction of a percent, and its memory is bounded whatever the corpus holds.

Defined cases: a null text is an empty text, which has the end id alone; rows that repeat are packed each;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .common import stored
from .tokens import encoder

CAPACITY, GROUP = 1024, 4096


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length (1 to capacity), taken in the order given."""
    open_ = [[] for _ in range(capacity + 1)]  # sequences by gap
    n = np.zeros(capacity + 1, np.int64)
    seq, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    made = 0
    for i, s in enumerate(lengths.tolist()):
        after = n[: capacity + 1 - s].copy()  # N(g - s) for g = s .. capacity
        change = 2 * after + 1
        change[0] = 0  # it would be full
        change -= 2 * n[s:] - 1
        change[n[s:] == 0] = np.iinfo(np.int64).max  # no such sequence is open
        best = int(change.argmin())
        gap = best + s
        if n[gap]:
            where = open_[gap].pop()
            n[gap] -= 1
        else:
            gap, where, made = capacity, made, made + 1
        seq[i], offset[i] = where, capacity - gap
        if gap > s:
            open_[gap - s].append(where)
            n[gap - s] += 1
    return seq, offset


def pieces(docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit integers) of all pieces."""
    ship(docs.sparkSession)

    def encode(rows):
        import pyarrow as pa

        enc, end = encoder(vocabulary), np.array([end_id], "<u4").tobytes()
        for batch in rows:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [x + end for x in enc.encode_all([t or "" for t in part.column("text").to_pylist()])]
                sizes = np.array([len(x) // 4 for x in ids])
                count = -(-sizes // capacity)
                doc = np.repeat(np.arange(len(ids)), count)
                nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                first = (sizes - 1) % capacity + 1
                start = np.where(nth == 0, 0, first[doc] + (nth - 1) * capacity)
                length = np.where(nth == 0, first[doc], capacity)
                cut = [ids[d][4 * a : 4 * (a + n)] for d, a, n in zip(doc, start, length, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(doc)), pa.array(nth.astype(np.int32)), pa.array(start), pa.array(length), pa.array(cut, pa.binary())], ["doc_id", "piece", "start", "length", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(encode, "doc_id long, piece int, start long, length long, ids binary")


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """pieces (with a column `length` of 1 to capacity) with sequence_id and offset. The rows are written once before they are dealt."""
    ship(pieces.sparkSession)
    made = stored(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    names = [c for c in made.columns if c != "row"]
    groups = max(1, -(-made.where(F.col("length") < capacity).count() // group))
    slots = made.where(F.col("length") < capacity).select("row", "length", F.pmod(F.xxhash64("row"), F.lit(groups)).alias("grp"))

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "row"], ascending=[False, True])
        seq, offset = sum_of_squares(pdf["length"].to_numpy(), capacity)
        return pd.DataFrame({"row": pdf["row"].to_numpy(), "sequence_id": pdf["grp"].to_numpy() * (2 * group * 1024) + seq, "offset": offset})

    tasks = max(min(groups, 4096), groups // 16)  # from one to sixteen groups each, whatever the input's size
    placed = slots.repartition(tasks, "grp").groupBy("grp").applyInPandas(place, "row long, sequence_id long, offset long")
    short = made.where(F.col("length") < capacity).join(placed, "row").select(*names, "sequence_id", "offset")
    full = made.where(F.col("length") >= capacity).select(*names, (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return short.union(full)
