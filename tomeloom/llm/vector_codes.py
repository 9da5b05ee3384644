"""Vector code compression: product codes whose nearest entries are found by a VA-file of the codebooks.

Vectors become integers and are cut into equal parts. For each part position there is a codebook of a few entries. Of these the VA-file keeps, for each
coordinate, a cell of a few bits; a part's lookup tables hold, for each coordinate and cell, the least and the largest squared distance to it, so
sums of table values bound the distance to every entry from below and above. Entries whose lower bound is over the least upper bound are out; for the
others the integer distance decides, ties to the lower index. Codebooks are made in rounds: parts are assigned, each task adds up its parts by entry, Spark adds the
tasks' sums, and an entry becomes the floor of its parts' mean. Only codebooks pass through the driver: parts * entries * coordinates numbers.

Defined cases: vectors that are null or hold null or non-finite components are dropped. The length of vectors is that of the kept row of least
vec_id (nulls last, ties by the vector itself) whose length is a positive multiple of the number of parts; rows of another length, or with a component beyond 2^27 in integers, stay
with a null code and error. Rows that repeat are rows each; with fewer rows than entries, codebooks are smaller; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

LARGEST = 1 << 27
BITS = 3


def cells(entries: np.ndarray, bits: int = BITS):
    """The VA-file of a codebook (entries x coordinates): each coordinate's cell, and the borders of all cells (coordinates x cells, from and to)."""
    low, high = entries.min(0), entries.max(0)
    width = (high - low) // (1 << bits) + 1
    start = low[:, None] + width[:, None] * np.arange(1 << bits)
    return (entries - low) // width, start, start + width[:, None] - 1


def nearest(parts: np.ndarray, entries: np.ndarray, bits: int = BITS, block: int = 4096):
    """Index and squared distance of each part's nearest entry."""
    cell, start, end = cells(entries, bits)
    column = np.arange(entries.shape[1])
    which, dist = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
    for at in range(0, len(parts), block):
        x = parts[at : at + block]
        below, above = start - x[:, :, None], x[:, :, None] - end
        least = np.maximum(np.maximum(below, above), 0) ** 2
        most = np.maximum(np.abs(below), np.abs(above)) ** 2
        lower, upper = np.zeros((len(x), len(entries)), np.int64), np.zeros((len(x), len(entries)), np.int64)
        for d in column:
            lower += least[:, d, cell[:, d]]
            upper += most[:, d, cell[:, d]]
        row, entry = np.nonzero(lower <= upper.min(1)[:, None])
        real = np.full(lower.shape, np.iinfo(np.int64).max)
        real[row, entry] = ((x[row] - entries[entry]) ** 2).sum(1)
        which[at : at + block] = real.argmin(1)
        dist[at : at + block] = real[np.arange(len(x)), which[at : at + block]]
    return which, dist


@dataclass
class Codebooks:
    """entries: parts x entries x coordinates."""

    entries: np.ndarray

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def integers(vectors: DataFrame, scale: int = 4096, vec_col: str = "embedding") -> DataFrame:
    """vectors whose components are all finite, with q in place of the vector: floor(scale * x) of each."""
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = vectors.withColumn("q", F.col(vec_col).cast("array<double>")).drop(vec_col).where(F.col("q").isNotNull() & F.forall("q", good))
    return v.withColumn("q", F.transform("q", lambda x: F.floor(x * F.lit(float(scale)))))


def _matrix(column) -> np.ndarray:
    """An Arrow column of lists of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), -1)


def fit(q: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, id_col: str = "vec_id") -> Codebooks:
    """q (id, q): rows that can be coded, all of one length. Each round is one pass over all of them."""
    first = q.orderBy(F.asc_nulls_last(id_col), "q").limit(entries).collect()
    if not first:
        return Codebooks(np.zeros((parts, 0, 0), np.int64))
    books = np.stack([np.split(np.array(r.q, np.int64), parts) for r in first], axis=1)

    def sums(books):
        def run(rows):
            import pyarrow as pa

            total, count = np.zeros(books.shape, object), np.zeros(books.shape[:2], np.int64)
            for batch in rows:
                x = _matrix(batch.column("q"))
                for p, part in enumerate(np.split(x, parts, 1) if len(x) else []):
                    which, _ = nearest(part, books[p])
                    mine = np.zeros(books.shape[1:], np.int64)
                    np.add.at(mine, which, part)
                    total[p] += mine
                    count[p] += np.bincount(which, minlength=books.shape[1])
            p, e = np.nonzero(count)
            d = books.shape[2]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(p, d).astype(np.int32)), pa.array(np.repeat(e, d).astype(np.int32)), pa.array(np.tile(np.arange(d, dtype=np.int32), len(p))), pa.array([int(v) for v in total[p, e].reshape(-1)], pa.int64()), pa.array(np.repeat(count[p, e], d))],
                ["part", "entry", "place", "total", "n"],
            )

        return run

    for _ in range(rounds):
        found = q.select("q").mapInArrow(sums(books), "part int, entry int, place int, total long, n long")
        added = found.groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect()
        books = books.copy()
        for r in added:
            books[r.part, r.entry, r.place] = int(r.total) // r.n
    return Codebooks(books)


def encode(q: DataFrame, books: Codebooks) -> DataFrame:
    """q with code (each part's entry in two hex digits) and error (squared distances summed over parts) in place of q."""
    keep, parts, table = [c for c in q.columns if c != "q"], len(books.entries), books.entries

    def run(rows):
        import pyarrow as pa

        for batch in rows:
            x = _matrix(batch.column("q"))
            code, error = np.zeros((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
            for p, part in enumerate(np.split(x, parts, 1) if len(x) else []):
                which, dist = nearest(part, table[p])
                code[:, p] = which
                error += dist
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array([r.tobytes().hex() for r in code], pa.string()), pa.array(error)], [*keep, "code", "error"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in q.select(*keep).schema)
    return q.mapInArrow(run, f"{kinds}, code string, error long")


def decode(coded: DataFrame, books: Codebooks, scale: int = 4096) -> DataFrame:
    """coded with approx: the vector that its code stands for (each entry's middle of a step is half of 1 / scale up)."""
    table = F.array(*[F.array(*[F.array(*[F.lit((int(v) + 0.5) / scale) for v in e]) for e in book]) for book in books.entries])
    at = lambda p: F.conv(F.substring("code", p * 2 + 1, 2), 16, 10).cast("int")
    whole = F.flatten(F.array(*[F.get(F.get(table, F.lit(p)), at(p)) for p in range(len(books.entries))]))
    return coded.withColumn("approx", F.when(F.col("code").isNotNull(), whole))


def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, Codebooks]:
    """(the id, label if there is one, code, error) of each kept row, and the codebooks; for entries up to 256."""
    keep = [c for c in (id_col, "label") if c in vectors.columns]
    q = stored(integers(vectors.select(*keep, vec_col), scale, vec_col), "vector-integers")
    fits = F.forall("q", lambda x: F.abs(x) <= LARGEST) & (F.size("q") > 0) & (F.size("q") % parts == 0)
    first = q.where(fits).orderBy(F.asc_nulls_last(id_col), "q").select(F.size("q")).first()
    fits = fits & (F.size("q") == (first[0] if first else -1))
    good = q.where(fits)
    books = fit(good, parts, entries, rounds, id_col)
    rest = q.where(~fits).select(*keep, F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    return (encode(good, books) if first else rest.limit(0)).unionByName(rest), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """coded (label, error, ...) with label_error: error summed over equal labels, nulls together."""
    coded = stored(coded, "vector-codes")
    sums = stored(coded.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error")), "label-errors")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("same")), "left").drop("same")
