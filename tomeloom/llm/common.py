"""What the training-data operators share: the shared folder, row keys, native words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_dir, ship, stored

__all__ = ["batches", "crc_mod", "first_rows", "n_words", "shared_dir", "stored", "table", "text_key", "word_array"]

#: Runs of these characters stand between words (all ASCII but digits and a-z, after lower-casing A-Z).
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_array(text: Column) -> Column:
    """Lower-cased (A-Z only) words of a text; null has none."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), NON_WORD)
    return F.filter(parts, lambda w: w != "")


def n_words(text: Column) -> Column:
    """size(word_array(text)) without the copies: only the ends of the split can be empty."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), NON_WORD)
    last = F.when(F.size(parts) > 1, (F.element_at(parts, -1) == "").cast("long")).otherwise(F.lit(0))
    return F.size(parts).cast("long") - (F.element_at(parts, 1) == "").cast("long") - last


def text_key(text: Column) -> Column:
    """With doc_id it names a row: rows that agree in both are copies and get the same result."""
    return F.xxhash64(text)


def crc_mod(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % n


def first_rows(rows: DataFrame, by: str, luck: str, most_rows: int, limit: Column, most_bytes: Column, size: Column) -> DataFrame:
    """The rows of least `luck` of each value of `by`: at most `limit` (itself at most most_rows) of them, and as long as their sizes add up to most_bytes.

    rows are written once; only numbers are then ordered, and those chosen, at most most_rows for each value of `by`, pick the rows.
    """
    kept = stored(rows.withColumn("row", F.monotonically_increasing_id()).withColumn("size", size.cast("long")), "sample")
    place = Window.partitionBy(by).orderBy(luck, "row")
    few = kept.select(by, luck, "row", "size").withColumn("nth", F.row_number().over(place)).where(F.col("nth") <= most_rows)
    total = F.sum("size").over(place.rowsBetween(Window.unboundedPreceding, 0))
    few = few.withColumn("total", total).where((F.col("nth") <= limit) & (F.col("total") <= most_bytes)).select("row")
    return kept.join(F.broadcast(few), "row", "left_semi").select(*rows.columns)


def batches(rows, most_bytes: int = 2 << 20):
    """Slices of the text column `text` of Arrow batches, of about most_bytes of text each, as (batch slice, bytes, offsets).

    A longer text comes alone and whole. Null texts are empty.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in rows:
        text = pc.fill_null(batch.column("text"), "").cast(pa.large_string())
        ends = np.frombuffer(text.buffers()[1], "<i8")[text.offset : text.offset + len(text) + 1]
        data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
        at = 0
        while at < len(text):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + most_bytes, "right")) - 1)
            yield batch.slice(at, to - at), data[ends[at] : ends[to]], ends[at : to + 1] - ends[at]
            at = to
