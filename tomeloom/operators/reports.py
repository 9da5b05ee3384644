"""Counts, renderings and quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clip, percentage, preview
from .progress import STATES


def run_stats(tree: DataFrame, leaves: DataFrame, ideas: DataFrame) -> DataFrame:
    """One row for each book. ideas: chunks with concept, is_duplicate and error. leaves: of the same run. A chapter with an error in a chunk has failed."""
    chapters = tree.groupBy("book_id").agg(F.count_if(F.col("level") == 1).alias("total_chapters"))
    sections = leaves.groupBy("book_id").agg(F.count("*").alias("total_sections"))
    kept = ~F.col("is_duplicate") & F.col("concept").isNotNull()
    made = ideas.groupBy("book_id").agg(
        F.count("*").alias("total_paragraphs"), F.count_if(F.col("concept").isNotNull()).alias("extracted_ideas"), F.count_if(kept).alias("total_ideas"),
        F.count_if(kept & (F.col("concept") != "")).alias("named_ideas"), F.count_if(F.col("is_duplicate")).alias("duplicates"),
    )
    failed = ideas.where("error is not null").groupBy("book_id").agg(F.count_distinct("chapter_number").alias("failed_chapters"))
    counts = ["total_paragraphs", "extracted_ideas", "total_ideas", "named_ideas", "duplicates"]
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    found = chapters.join(sections, "book_id", "left").join(made, "book_id", "left").join(failed, "book_id", "left")
    done = F.col("total_chapters") - zero("failed_chapters")
    return found.select("book_id", "total_chapters", done.alias("completed_chapters"), zero("failed_chapters").alias("failed_chapters"), *[zero(c).alias(c) for c in ["total_sections", *counts]])


def run_summary(stats: DataFrame) -> DataFrame:
    """book_id, summary: run_stats() as a few lines for people."""
    shown = [("method", F.lit("toc")), *[(label, F.col(c)) for label, c in (("chapters", "total_chapters"), ("sections", "total_sections"), ("completed", "completed_chapters"), ("failed", "failed_chapters"), ("paragraphs", "total_paragraphs"), ("ideas", "total_ideas"), ("duplicates skipped", "duplicates"))]]
    return stats.select("book_id", F.concat_ws("\n", *[F.concat(F.lit(label + ": "), c.cast("string")) for label, c in shown]).alias("summary"))


def concept_counts(ideas: DataFrame) -> DataFrame:
    """Chapters, paragraphs and concepts that aren't empty, for each book."""
    return ideas.groupBy("book_id").agg(F.count_distinct("chapter_number").alias("n_chapters"), F.count("*").alias("n_paragraphs"), F.count_if(F.coalesce(F.col("concept"), F.lit("")) != "").alias("n_concepts"))


def inspection_report(state: DataFrame, chunks: DataFrame, ideas: DataFrame) -> DataFrame:
    """Units by status, completion, chunks with their page range and place in the outline, and ideas of each book."""
    s = state.groupBy("book_id").agg(F.count("*").alias("units"), *[F.count_if(F.col("status") == k).alias(k) for k in STATES])
    c = chunks.groupBy("book_id").agg(F.count("*").alias("n_chunks"), F.min("page_number").alias("first_page"), F.max("page_number").alias("last_page"), F.min("toc_idx").alias("first_place"), F.max("toc_idx").alias("last_place"))
    i = ideas.groupBy("book_id").agg(F.count("*").alias("n_ideas"))
    zero = lambda x: F.coalesce(x, F.lit(0).cast("long")).alias(x)
    return s.join(c, "book_id", "full").join(i, "book_id", "full").select("book_id", zero("units"), *[zero(k) for k in STATES], F.round(percentage(F.coalesce("completed", F.lit(0)), F.coalesce("units", F.lit(0))), 4).alias("completion"), zero("n_chunks"), "first_page", "last_page", "first_place", "last_place", zero("n_ideas"))


def structure_tree(tree: DataFrame, chapters: int = 10, sections: int = 5, children: int = 3) -> DataFrame:
    """Lines of an outline: the first entries under each parent, and how many more there are."""
    rank = F.row_number().over(Window.partitionBy("book_id", "parent_idx").orderBy("toc_idx"))
    total = F.count("*").over(Window.partitionBy("book_id", "parent_idx"))
    limit = F.when(F.size("anc") == 1, chapters).when(F.size("anc") == 2, sections).otherwise(children)
    shown = tree.withColumns({"rank": rank, "siblings": total}).withColumn("most", limit).where("rank <= most")
    more = F.when((F.col("rank") == F.col("most")) & (F.col("siblings") > F.col("most")), F.col("siblings") - F.col("most")).otherwise(0)
    depth = F.size("anc") - 1
    return shown.select("book_id", "toc_idx", depth.alias("depth"), F.concat(F.repeat(F.lit("  "), depth), clip(F.col("title"))).alias("line"), more.cast("long").alias("more"))


def chunk_preview(chunks: DataFrame, text: str = "paragraph") -> DataFrame:
    return chunks.withColumn("preview", preview(F.col(text)))


def result_tree_json(ideas: DataFrame) -> DataFrame:
    """book_id, chapter_number, result: a chapter's sections with their paragraphs as JSON. For chapters that fit a row."""
    para = F.struct(F.col("section_paragraph_index").alias("index"), F.col("paragraph").alias("text"), F.length("paragraph").alias("text_length"), "concept")
    sections = ideas.groupBy("book_id", "chapter_number", "chapter_title", "toc_idx", "title", "level", "hierarchy_path").agg(F.array_sort(F.collect_list(para)).alias("paragraphs"))
    body = F.struct("toc_idx", "title", "level", "hierarchy_path", F.size("paragraphs").alias("paragraph_count"), "paragraphs")
    chapters = sections.groupBy("book_id", "chapter_number", "chapter_title").agg(F.array_sort(F.collect_list(body)).alias("sections"))
    return chapters.select("book_id", "chapter_number", F.to_json(F.struct("chapter_number", F.col("chapter_title").alias("title"), F.size("sections").alias("section_count"), "sections")).alias("result"))


def write_result_json(ideas: DataFrame, path: str) -> None:
    """result_tree_json() as files of one JSON line for each chapter, in folders by book."""
    result_tree_json(ideas).select("book_id", "result").write.mode("overwrite").partitionBy("book_id").text(path)


def section_forward_fill(rows: DataFrame, title: str, key: str, order: str) -> DataFrame:
    """rows with section: the last title so far that is neither null nor the word null."""
    real = F.when(F.lower(title) != "null", F.col(title))
    return rows.withColumn("section", F.last(real, ignorenulls=True).over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))


def table_run_filter(lines: DataFrame, key: str, order: str, least: int = 3, pattern: str = r"(\|.*\||\t.*\t|\S {2,}\S+ {2,}\S)") -> DataFrame:
    """lines (key, order, line) without runs of `least` or more lines that look like rows of a table."""
    by = Window.partitionBy(key).orderBy(order)
    rows = lines.withColumn("table_like", F.col("line").rlike(pattern))
    rows = rows.withColumn("run", F.row_number().over(by) - F.row_number().over(Window.partitionBy(key, "table_like").orderBy(order)))
    size = F.count("*").over(Window.partitionBy(key, "table_like", "run"))
    return rows.withColumn("size", size).where(~F.col("table_like") | (F.col("size") < least)).select(*lines.columns)


def heading_chapters(lines: DataFrame) -> DataFrame:
    """Lines that read like a chapter's heading, by pattern."""
    return lines.where(F.col("line").rlike(r"^\s*(?i:chapter|part)\s+(\d+|[IVXLC]+)\b"))
