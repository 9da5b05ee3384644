"""An optional stream of pages: each micro-batch becomes chunks and ideas, deduplicated against the store."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import dedup_against_store, dedup_within_book
from ..schemas import PAGES


def page_stream(spark: SparkSession, path: str, files: int = 100) -> DataFrame:
    return spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files).parquet(path)


def ingest(pages: DataFrame, to_ideas: Callable[[DataFrame], DataFrame], store: str, checkpoint: str) -> StreamingQuery:
    """Append the new ideas of each batch to store (Parquet, partitioned by batch: a batch that is run again replaces its own rows).

    to_ideas maps pages to rows with book_id, concept and the order columns. No watermark is needed: the store is what new ideas are
    compared with, however late they come. A book's pages must arrive in one batch.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fresh = dedup_within_book(to_ideas(batch).where("concept is not null")).withColumnRenamed("concept", "core_idea_text")
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(store)
        if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
            known = spark.read.parquet(store).where(f"batch <> {number}")
            fresh = dedup_against_store(fresh.withColumnRenamed("core_idea_text", "concept"), known).withColumnRenamed("concept", "core_idea_text")
        fresh.write.mode("overwrite").parquet(f"{store}/batch={number}")

    return pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
