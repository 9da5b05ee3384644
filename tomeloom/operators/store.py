"""Rows of the stored tables, lookups and deletes on frames of them; sources/snapshots.py stores them. Ids come from natural keys, so a rerun makes the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import file_title
from ..schemas import key_id


def books_build(meta: DataFrame) -> DataFrame:
    """id, title (else the file's name), author (else Unknown), source_path."""
    title = F.coalesce(F.nullif("title", F.lit("")), file_title(F.col("source_path")))
    return meta.select(F.col("book_id").alias("id"), title.alias("title"), F.coalesce(F.nullif("author", F.lit("")), F.lit("Unknown")).alias("author"), "source_path")


def new_books(books: DataFrame, stored: DataFrame) -> DataFrame:
    """books whose title the store lacks."""
    return books.join(stored.select("title"), "title", "left_anti").select(*books.columns)


def repeated_titles(books: DataFrame) -> DataFrame:
    """books whose title one of a smaller id has."""
    first = books.groupBy("title").agg(F.min("id").alias("first"))
    return books.join(first, "title").where("id > first").select(*books.columns)


def book_exists(books: DataFrame, stored: DataFrame) -> DataFrame:
    known = stored.select("title").distinct().withColumn("known", F.lit(True))
    return books.join(known, "title", "left").select("id", "title", F.coalesce("known", F.lit(False)).alias("already_stored"))


def chapters_build(tree: DataFrame) -> DataFrame:
    return tree.where("level = 1").select(key_id("book_id", "toc_idx").alias("id"), "book_id", "chapter_number", "title", "level", F.lit("toc").alias("detection_method"))


def sections_build(tree: DataFrame) -> DataFrame:
    """Sections in preorder, numbered in their chapter, with the id of the chapter and of the parent section."""
    number = F.row_number().over(Window.partitionBy("book_id", "chapter_number").orderBy("toc_idx"))
    under = F.size("anc") > 2
    return tree.where("level > 1").select(
        key_id("book_id", "toc_idx").alias("id"), key_id("book_id", F.get("anc", F.lit(0))["idx"]).alias("chapter_id"), "book_id", "chapter_number", number.alias("section_number"),
        "title", "level", F.when(under, key_id("book_id", "parent_idx")).alias("parent_section_id"), F.when(under, F.col("parent_idx")).alias("parent_idx"), "toc_idx", F.lit("toc").alias("detection_method"),
    )


def section_title_map(sections: DataFrame) -> DataFrame:
    """The section of each title in a chapter; the last one of equals."""
    return sections.groupBy("book_id", "chapter_number", "title").agg(F.max("section_number").alias("section_number"))


def section_next_number(chapters: DataFrame, sections: DataFrame) -> DataFrame:
    top = sections.groupBy("book_id", "chapter_number").agg(F.max("section_number").alias("top"))
    return chapters.join(top, ["book_id", "chapter_number"], "left").select("book_id", "chapter_number", (F.coalesce("top", F.lit(0)) + 1).alias("next_number"))


def section_get_or_create(sections: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted (book_id, chapter_number, title): each with its number, the stored one or the next free one, and is_new."""
    key = ["book_id", "chapter_number"]
    have = sections.groupBy(*key, "title").agg(F.min("section_number").alias("section_number"))
    ask = wanted.select(*key, "title").distinct().join(have, [*key, "title"], "left")
    top = sections.groupBy(*key).agg(F.max("section_number").alias("top"))
    fresh = F.row_number().over(Window.partitionBy(*key, F.col("section_number").isNull()).orderBy("title"))
    found = ask.join(top, key, "left").withColumn("fresh", fresh)
    number = F.coalesce("section_number", F.coalesce("top", F.lit(0)) + F.col("fresh"))
    return found.select(*key, "title", number.alias("section_number"), F.col("section_number").isNull().alias("is_new"))


def parent_section_lookup(wanted: DataFrame, sections: DataFrame) -> DataFrame:
    """wanted (book_id, chapter_number, toc_idx, parent_title) with the number of the section of that title; an empty or unknown title has none."""
    titles = section_title_map(sections).where("title <> ''").withColumnRenamed("title", "parent_title").withColumnRenamed("section_number", "parent_number")
    return wanted.join(titles, ["book_id", "chapter_number", "parent_title"], "left").select("book_id", "chapter_number", "toc_idx", "parent_title", "parent_number")


def chunks_persisted(kept: DataFrame) -> DataFrame:
    """paragraph_chunks of kept ideas: chunks without an idea (null concept) or with a repeated one were dropped before. page_number is their section's first page;
    a chunk that stands right under a chapter has no section."""
    return kept.where("concept is not null").select(
        F.col("chunk_id").alias("id"), "book_id", "chapter_number", "toc_idx", F.col("page").alias("page_number"), F.col("book_paragraph_index").alias("paragraph_index"), "chapter_paragraph_index",
        F.col("paragraph").alias("body_text"), key_id("book_id", "chapter_idx").alias("chapter_id"), F.when(F.col("toc_idx") != F.col("chapter_idx"), key_id("book_id", "toc_idx")).alias("section_id"),
    )


def key_ideas_build(kept: DataFrame) -> DataFrame:
    """key_ideas, one for each persisted chunk; an empty concept is kept as it is."""
    return kept.where("concept is not null").select(key_id("book_id", "chunk_id", F.lit(0)).alias("id"), "chunk_id", "book_id", "chapter_number", "toc_idx", "hierarchy_path", F.col("concept").alias("core_idea_text"))


def lookup(rows: DataFrame, order: list[str] | None = None, **equal) -> DataFrame:
    """Rows with the given values, in the given order with nulls last: the one shape of all point lookups."""
    for k, v in equal.items():
        rows = rows.where(F.col(k) == v)
    return rows.orderBy(*[F.col(c).asc_nulls_last() for c in order]) if order else rows


def delete_where(rows: DataFrame, keys: DataFrame, on: list[str], children: dict[str, tuple[DataFrame, list[str]]] | None = None):
    """Rows without those that keys name, the number of deleted rows as a table, and the children left by a cascade."""
    left = rows.join(keys, on, "left_anti")
    gone = rows.join(keys, on, "left_semi")
    counts = gone.agg(F.count("*").alias("deleted"))
    return left, counts, {name: child.join(gone.select(*cols).distinct(), cols, "left_anti") for name, (child, cols) in (children or {}).items()}
