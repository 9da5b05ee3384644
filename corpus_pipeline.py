"""From raw documents to packed sequences: toxicity, line dedup, near-dedup, decontamination, packing.

Each stage gets what the one before kept, written as Parquet in the shared folder and read again. For all stages: empty tables give empty
tables; texts of any length are read whole; a null doc_id is a value like others; other columns, whatever their names, stay as they are.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeloom.llm import decontaminate, line_dedup, near_dedup, packing, toxicity
from tomeloom.llm.common import shared_dir, table
from tomeloom.llm.tokens import vocabulary
from tomeloom.session import scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that score under 0.3; learned from the labels of documents that are here (a bounded sample of them). Null and empty texts and texts without a
    word stay; rows that repeat are judged alike; without a label all stay."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.keep_clean(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of lines go from text; n_chars follows. No row goes: a text may become empty, a null one stays null, a text of one line stays as it is. The run
    that stays is the first by doc_id (nulls last), text key and place; rows that agree in doc_id and text are one document, each with the same result."""
    return line_dedup.dedup_runs(docs).withColumn("n_chars", F.length("text").cast("long"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates: the one of least doc_id (nulls last), of rows that repeat any one. Texts without a word are classes by equality, so one
    empty text stays; all rows with a null text stay."""
    return near_dedup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a benchmark window; null and empty texts have none and stay. Without benchmark items all stay."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of each piece; a null text is an empty one, which has the end id alone."""
    cut = packing.pieces(docs, vocabulary("byte_bpe_50k.json"))
    return packing.pack(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: A trained model, sketches and a tokenizer have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir. What a stage stores on its way goes when its result is written."""
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{base}/{i}-{name}")
        docs = spark.read.parquet(f"{base}/{i}-{name}")
    return docs
