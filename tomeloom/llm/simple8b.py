"""Token-id files: Simple-8b word-aligned coding.

A code word has 64 bits: a selector in the top 4 and a payload of 60. Selector s in 1..14 packs COUNT[s]
values of BITS[s] bits, the first in the lowest bits; selector 0 is an escape, and the next word holds one
value of up to 64 bits as it is. Values are packed greedily: each word takes as many as fit.

A block holds whole documents and is decoded on its own: a header of six unsigned 64-bit integers (magic,
documents, ids, words, offsets, bytes of the length section), then two such streams, each as words and a
table of offsets. Every SKIP words the offset table notes how many values came before (its highest bit: the word there is the
raw one of an escape), so the words of each stretch are placed by themselves, and a reader may start at any of them:
from_block() reads a range of a block's documents without decoding the rest. The first stream holds the documents' lengths, the second their ids.

write() range-partitions documents by doc_id (rows that agree in doc_id by text), sorts them and writes
Parquet files whose rows are blocks, in order, each with its file part, place and number of ids. read()
opens such files, sums ids part by part (a row for each part, then for each block) and decodes
the blocks vectorised. Defined cases: null texts are empty texts, and an empty text has the end id alone;
a null doc_id sorts first; an empty table gives no blocks and no rows; rows that repeat are kept.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship
from .common import shared_dir
from .tokens import encoder

#: Fixed values of the format, by selector: values in a word and bits of each (0: escape).
COUNT = [1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1]
BITS = [64, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60]
MAGIC, SKIP, RAW = 0x53384242, 128, np.uint64(1 << 63)
BROADCAST_BLOCKS = 500_000
LIMITS = np.array([1 << b for b in BITS[1:]], np.uint64)
NEED = (np.searchsorted(LIMITS, np.arange(1 << 16, dtype=np.uint64), "right") + 1).astype(np.uint8)


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code words of unsigned values, and the offset table."""
    v = np.asarray(values, np.uint64)
    n = len(v)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    need = NEED[v] if int(v.max()) < len(NEED) else np.searchsorted(LIMITS, v, "right").astype(np.uint8) + 1  # least selector by bits; 15: escape
    choice = np.where(need == 15, 0, 14).astype(np.uint8)
    for s in range(13, 0, -1):  # wider counts overwrite narrower ones
        c = COUNT[s]
        if n < c:
            continue
        fits, p = need <= s, 1
        while 2 * p <= c:  # fits[i]: the p values from i on fit
            fits, p = fits[:-p] & fits[p:], 2 * p
        np.putmask(choice[: n - c + 1], fits[: n - c + 1] & fits[c - p : n - p + 1], s)
    step = np.array(COUNT, np.int64)[choice].tolist()
    at, i = [], 0
    add = at.append
    while i < n:
        add(i)
        i += step[i]
    at = np.array(at)
    sel = choice[at]
    width = 1 + (sel == 0)
    place = np.cumsum(width) - width
    out = np.zeros(int(width.sum()), np.uint64)
    for s in np.unique(sel):
        mine = np.flatnonzero(sel == s)
        if s == 0:
            out[place[mine] + 1] = v[at[mine]]
            continue
        word = np.full(len(mine), np.uint64(int(s) << 60))
        for j in range(COUNT[s]):
            word |= v[at[mine] + j] << np.uint64(j * BITS[s])
        out[place[mine]] = word
    before = np.zeros(len(out), np.uint64)
    before[place] = at
    before[place[sel == 0] + 1] = (at[sel == 0] + 1).astype(np.uint64) | RAW  # its value is counted already
    return out, before[::SKIP]


def unpack(words: np.ndarray, offsets: np.ndarray | None = None) -> np.ndarray:
    """All values of a stream or of a run of its stretches, vectorised: one pass for each selector.

    With the stretches' offsets each is placed by itself; without, values are counted from the first word, which is no raw one.
    """
    words = np.asarray(words, np.uint64)
    if not len(words):
        return np.zeros(0, np.uint64)
    sel = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    raw[0] = offsets is not None and offsets[0] >= RAW
    for i in np.flatnonzero(sel == 0):  # a raw word may look like an escape; escapes are rare
        raw[i + 1 : i + 2] = not raw[i]
    count = np.array(COUNT + [0], np.int64)[sel]
    count[raw] = 0
    each = np.add.reduceat(count, np.arange(0, len(count), SKIP))
    base = np.cumsum(each) - each if offsets is None else (offsets & ~RAW).astype(np.int64)
    stretch = np.zeros(len(base) * SKIP, np.int64)
    stretch[: len(count)] = count
    stretch = stretch.reshape(-1, SKIP)
    start = (np.cumsum(stretch, 1) - stretch + (base - base[0])[:, None]).reshape(-1)[: len(count)]
    out = np.zeros(int(count.sum()), np.uint64)
    if start[-1] + count[-1] != len(out):
        raise ValueError("a block is damaged")
    for s in np.unique(sel[~raw]):
        mine = np.flatnonzero((sel == s) & ~raw)
        if s == 0:
            mine = mine[mine + 1 < len(words)]  # an escape at the end of a run of stretches: its word is not in it
            out[start[mine]] = words[mine + 1]
            continue
        mask = np.uint64((1 << BITS[s]) - 1)
        for j in range(COUNT[s]):
            out[start[mine] + j] = (words[mine] >> np.uint64(j * BITS[s])) & mask
    return out


def to_block(lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One block of documents: their lengths and the ids of all of them."""
    (lw, lo), (w, o) = pack(lengths), pack(ids)
    head = np.array([MAGIC, len(lengths), len(ids), len(w), len(o), 8 * (2 + len(lw) + len(lo))], "<u8")
    return b"".join(x.astype("<u8").tobytes() for x in (head, np.array([len(lw), len(lo)]), lw, lo, w, o))


def from_block(block: bytes, first: int = 0, last: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and ids of the documents first to last (not included; none: the block's end)."""
    x = np.frombuffer(block, "<u8")
    if len(x) < 8 or x[0] != MAGIC:
        raise ValueError("this is no Simple-8b block")
    _, docs, n, w, o, section = (int(a) for a in x[:6])
    lw, lo = int(x[6]), int(x[7])
    if 8 * len(x) != 48 + section + 8 * (w + o) or section != 8 * (2 + lw + lo):
        raise ValueError("a block is damaged")
    lengths = unpack(x[8 : 8 + lw], x[8 + lw : 8 + lw + lo])
    words, offsets = x[8 + lw + lo :][:w], x[8 + lw + lo + w :]
    if len(lengths) != docs or int(lengths.sum()) != n:
        raise ValueError("a block is damaged")
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    a, b = int(ends[first]), int(ends[docs if last is None else last])
    if a == b:
        return lengths[first:last], np.zeros(0, np.uint64)
    base = (offsets & ~RAW).astype(np.int64)
    i, j = int(np.searchsorted(base, a, "right")) - 1, int(np.searchsorted(base, b, "left"))
    over = int(j < len(base) and offsets[j] >= RAW)  # the word of an escape that ends the last stretch
    ids = unpack(words[i * SKIP : j * SKIP + over], offsets[i : j + over])
    ids = ids[a - base[i] : b - base[i]]
    if len(ids) != b - a:
        raise ValueError("a block is damaged")
    return lengths[first:last], ids


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int = 1, partitions: int | None = None, block_ids: int = 1 << 17) -> None:
    """Encode whole texts and write their ids as blocks in ascending doc_id order."""
    ship(docs.sparkSession)

    def encode(rows):
        import pyarrow as pa
        from pyspark import TaskContext

        enc, part = encoder(vocabulary), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        place, keys, coded, size = 0, [], [], 0
        names = ["part", "place", "n_ids", "doc_ids", "block"]

        def block():
            lengths = np.array([len(x) // 4 for x in coded])
            made = to_block(lengths, np.frombuffer(b"".join(coded), "<u4"))
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([place], pa.int64()), pa.array([int(lengths.sum())], pa.int64()), pa.array([keys], pa.list_(pa.int64())), pa.array([made], pa.binary())], names)

        for batch in rows:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                for key, ids in zip(piece.column("doc_id").to_pylist(), enc.encode_all([t or "" for t in piece.column("text").to_pylist()]), strict=True):
                    keys.append(key)
                    coded.append(ids + end)
                    size += len(ids) // 4 + 1
                    if size >= block_ids:
                        yield block()
                        place, keys, coded, size = place + 1, [], [], 0
        if keys:
            yield block()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    by = (F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    dealt = rows.repartitionByRange(partitions, *by) if partitions else rows.repartitionByRange(*by)
    dealt.sortWithinPartitions(*by, "text").mapInArrow(encode, "part long, place long, n_ids long, doc_ids array<long>, block binary").write.option("compression", "uncompressed").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian unsigned 32-bit integers) of every document in the files."""
    ship(spark)
    blocks = spark.read.schema("part long, place long, n_ids long, doc_ids array<long>, block binary").parquet(path)
    sizes = blocks.select("part", "place", "n_ids")
    before_part = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", before_part.alias("base"))  # one row for each file part
    before_block = F.coalesce(F.sum("n_ids").over(Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("part", "place", before_block.alias("inner")).join(parts, "part").select("part", "place", (F.col("base") + F.col("inner")).alias("start"))

    def decode(rows):
        import pyarrow as pa

        for batch in rows:
            for start, keys, block in zip(*(batch.column(c) for c in ("start", "doc_ids", "block")), strict=True):
                lengths, ids = from_block(block.as_buffer())
                ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
                ids = ids.astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array(keys.as_py(), pa.int64()), pa.array(ends[:-1] + start.as_py()), pa.array(np.diff(ends)), pa.array([ids[4 * a : 4 * b] for a, b in zip(ends, ends[1:], strict=False)], pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    starts = F.broadcast(starts) if sizes.count() <= BROADCAST_BLOCKS else starts  # a block has some 131,000 ids
    placed = blocks.select("part", "place", "doc_ids", "block").join(starts, ["part", "place"]).select("start", "doc_ids", "block")
    return placed.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")


def round_trip(docs: DataFrame, vocabulary: str, end_id: int = 1) -> DataFrame:
    """write() to a new folder in the shared one, then read() it."""
    path = f"{shared_dir(docs.sparkSession)}/token-files-{uuid.uuid4().hex}"
    write(docs, path, vocabulary, end_id)
    return read(docs.sparkSession, path)
