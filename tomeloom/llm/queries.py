"""The queries opN_<name>, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, langid, lexical, license_scan, line_dedup, near_dedup, packing, simple8b, topk, toxicity, url_filter, vector_codes
from .common import crc_mod, table
from .tokens import vocabulary


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    part = crc_mod(F.col("doc_id"), 3)
    model = langid.fit(docs, part != 1)
    return langid.identify(docs, model).withColumn("held_out", F.coalesce(crc_mod(F.col("doc_id"), 3) == 1, F.lit(False)))


def op3_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simple8b.round_trip(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "kept")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, crc_mod(F.col("doc_id"), 4) != 2)
    found = toxicity.score(docs, model)
    return found.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("spans")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return packing.pack(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items", "spans")


def line_results(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_lines", "n_removed", "n_chunks", F.length("text").cast("long").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole chunks only, as its SQL does."""
    return line_results(line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), stats=True))


def op10_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All repeated runs of lines."""
    return line_results(line_dedup.dedup_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), stats=True))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_error(coded).withColumn("codebooks_sha256", F.lit(books.sha256())).drop("label")


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary("byte_bpe_50k.json"))
    return bpe.digests(found).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    found = (op1_topk, op2_langid, op3_tokens, op4_near_dedup, op5_toxicity, op6_url_filter, op7_license_scan, op8_packing, op9_decontaminate, op10_line_dedup, op10_line_runs, op11_vector_codes, op12_lexical, op13_bpe, pipeline)
    return {f.__name__: f for f in found}
