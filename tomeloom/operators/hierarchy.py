"""Outline entries to chapters, sections, leaves and their text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, EngineConfig
from ..functions.prefix import is_small, running
from ..functions.text import is_front_matter
from ..session import stored
from .pages import normalized_pages, positions

BUCKET = 1 << 14
MOST_LEVELS = 64


def toc_char_positions(toc: DataFrame, pages: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """toc with pos: where its page starts; an unknown page is where the last one ends; a book without pages has 0."""
    at = positions(pages, config)
    last = at.groupBy("book_id").agg(F.max_by("end_char", "page_num").alias("last_end"))
    placed = toc.join(at.select("book_id", F.col("page_num").alias("page"), "start_char"), ["book_id", "page"], "left").join(last, "book_id", "left")
    return placed.select("book_id", "toc_idx", "level", "title", "page", F.coalesce("start_char", "last_end", F.lit(0)).cast("long").alias("pos"))


def text_sizes(pages: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """book_id, size of the normalized text."""
    return normalized_pages(pages, config).groupBy("book_id").agg(F.max("end_char").alias("size"))


def with_depth(toc: DataFrame, small: bool = False) -> DataFrame:
    """Entries that have a level, with depth (the rank of their level in their book), and the book's least level and largest depth."""
    if small:
        book, toc = Window.partitionBy("book_id"), toc.where("level is not null").withColumn("depth", F.dense_rank().over(Window.partitionBy("book_id").orderBy("level")))
        return toc.withColumns({"least": F.min("level").over(book), "deepest": F.max("depth").over(book)})
    book, levels = Window.partitionBy("b"), toc.where("level is not null").select(F.col("book_id").alias("b"), F.col("level").alias("l")).distinct()
    ranked = levels.withColumns({"depth": F.row_number().over(book.orderBy("l")), "least": F.min("l").over(book), "deepest": F.count("*").over(book).cast("int")})
    return toc.join(stored(ranked, "levels"), F.col("book_id").eqNullSafe(F.col("b")) & (F.col("level") == F.col("l"))).drop("b", "l")


def bad_outlines(toc: DataFrame) -> DataFrame:
    """book_id and error of outlines with a level below 1, or of more than MOST_LEVELS distinct levels: such books have no tree."""
    bad = with_depth(toc).where((F.col("least") < 1) | (F.col("deepest") > MOST_LEVELS)).groupBy("book_id").agg(F.min("least").alias("least"))
    return bad.select("book_id", F.when(F.col("least") < 1, "a level below 1").otherwise(f"over {MOST_LEVELS} levels").alias("error"))


def nested(toc: DataFrame, sizes: DataFrame) -> DataFrame:
    """Each entry under a level 1: book_id, toc_idx, level, title, page, term (next entry of its level or above), anc (its
    enclosing entries from the outside, then itself: idx and title), parent_idx, start_char, end_char, is_leaf, chapter_number.

    An entry's enclosing ones are, for each smaller level l, the last entry before it of level l or less. So running
    maxima for each depth give all, none of them a join of entries with entries; a long outline is dealt into blocks. Levels are ranked in their own book, whatever others have.
    Entries without a level are left out, and the books of bad_outlines().
    """
    small = is_small(toc)
    toc = with_depth(toc, small).where((F.col("least") >= 1) & (F.col("deepest") <= MOST_LEVELS)).drop("least")
    toc = toc if small else stored(toc, "outline")
    levels = list(range(1, (toc.agg(F.max("deepest")).first()[0] or 1) + 1))
    own = F.struct(F.col("toc_idx").alias("idx"), "title", "pos", "term", "until")
    rows = toc.join(sizes, "book_id", "left").withColumn("size", F.coalesce("size", F.lit(0)))
    place = F.struct(F.col("toc_idx").alias("idx"), "pos")
    after = {f"next{v}": ("min_after", F.when(F.col("depth") <= v, place)) for v in levels}
    more = {"next_level": ("next", F.col("level")), "chapters": ("sum_before", (F.col("level") == 1).cast("int"))}
    rows = running(rows, ["book_id"], "toc_idx", after | more, small=small)
    rows = rows if small else stored(rows, "outline-ends")
    rows = rows.withColumn("next", F.get(F.array(*after), F.col("depth") - 1)).drop(*after)
    rows = rows.withColumn("term", F.col("next.idx")).withColumn("until", F.coalesce("next.pos", "size"))
    before = {f"last{v}": ("max_before", F.when(F.col("depth") <= v, own)) for v in levels[:-1]}
    rows = running(rows, ["book_id"], "toc_idx", before, small=small) if before else rows
    above = [F.when(F.col("depth") > v, F.col(f"last{v}")) for v in levels[:-1]]
    rows = rows.withColumn("anc", F.array_sort(F.array_distinct(F.array_compact(F.array(*above, own)))))
    rows = rows.withColumn("is_leaf", F.coalesce(F.col("next_level") <= F.col("level"), F.lit(True)))
    rows = rows.withColumn("chapter_number", F.col("chapters") + (F.col("level") == 1).cast("int")).where("chapter_number > 0")
    start, end = F.array_max(F.transform("anc", lambda a: a.pos)), F.array_min(F.transform("anc", lambda a: a.until))
    parent = F.when(F.size("anc") > 1, F.get("anc", F.size("anc") - 2)["idx"])
    return rows.select("book_id", "toc_idx", "level", "title", "page", "term", "anc", parent.alias("parent_idx"), start.alias("start_char"), end.alias("end_char"), "is_leaf", F.col("chapter_number").cast("int").alias("chapter_number"))


def structure(toc: DataFrame, pages: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """nested() with all that is needed from pages."""
    return nested(toc_char_positions(toc, pages, config), text_sizes(pages, config))


def chapter_spans(tree: DataFrame) -> DataFrame:
    return tree.where("level = 1").select("book_id", "chapter_number", "title", "toc_idx", "start_char", "end_char", F.lit("toc").alias("detection_method"))


def section_spans(tree: DataFrame) -> DataFrame:
    return tree.where("level > 1").select("book_id", "chapter_number", "toc_idx", "level", "title", "parent_idx", "start_char", "end_char", F.greatest(F.col("end_char") - F.col("start_char"), F.lit(0)).alias("n_chars"))


def section_parents(tree: DataFrame) -> DataFrame:
    """Sections with their parent section's title (null right under a chapter)."""
    parent = F.when(F.size("anc") > 2, F.get("anc", F.size("anc") - 2)["title"])
    return tree.where("level > 1").select("book_id", "toc_idx", "parent_idx", parent.alias("parent_title"))


def section_counts(tree: DataFrame) -> DataFrame:
    return tree.groupBy("book_id", "chapter_number").agg(F.count_if(F.col("level") > 1).alias("n_sections"))


def leaf_sections(tree: DataFrame) -> DataFrame:
    """Leaves in preorder with their path; a chapter without sections gives one leaf with an empty title, level 2 and its own span."""
    path = F.aggregate("anc", F.lit(""), lambda a, x: F.when(a == "", x.title).otherwise(F.concat(a, F.lit(" > "), x.title)))
    alone = F.col("level") == 1
    return tree.where("is_leaf").select("book_id", "chapter_number", "toc_idx", F.when(alone, "").otherwise(F.col("title")).alias("title"), F.when(alone, 2).otherwise(F.col("level")).alias("level"), path.alias("hierarchy_path"), F.get("anc", F.lit(0))["title"].alias("chapter_title"), F.get("anc", F.lit(0))["idx"].alias("chapter_idx"), F.when(F.size("anc") > 2, F.get("anc", F.size("anc") - 2)["title"]).alias("parent_title"), "page", "start_char", "end_char")


def with_content(spans: DataFrame, pages: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """spans (book_id, toc_idx, start_char, end_char ...) with content, the text in their span.

    Pages and spans meet in buckets of BUCKET characters of a book, in the first bucket they share; a section is put together
    from its pages alone, so no book is ever one string and a long book's sections are spread over tasks.
    """
    part = normalized_pages(pages, config).select("book_id", F.col("start_char").alias("p0"), F.col("end_char").alias("p1"), F.concat("text", "glue").alias("part")).where("p1 > p0")
    bucket = lambda c: F.floor(c / BUCKET)
    part = part.withColumn("first", bucket(F.col("p0"))).withColumn("b", F.explode(F.sequence("first", bucket(F.col("p1") - 1))))
    some = spans.where("end_char > start_char").select("book_id", "toc_idx", F.col("start_char").alias("s0"), F.col("end_char").alias("s1"))
    some = some.withColumn("begin", bucket(F.col("s0"))).withColumn("b", F.explode(F.sequence("begin", bucket(F.col("s1") - 1))))
    met = some.join(part, ["book_id", "b"]).where("b = greatest(first, begin) and p0 < s1 and s0 < p1")
    met = met.select("book_id", "toc_idx", "p0", F.expr("substring(part, int(greatest(s0 - p0, 0)) + 1, int(least(s1, p1) - greatest(s0, p0)))").alias("piece"))
    whole = met.groupBy("book_id", "toc_idx").agg(F.expr("listagg(piece, '') WITHIN GROUP (ORDER BY p0)").alias("content"))
    return spans.join(whole, ["book_id", "toc_idx"], "left").withColumn("content", F.coalesce("content", F.lit("")))


def front_matter_filter(titles: DataFrame) -> DataFrame:
    """Rows whose title opens no front matter."""
    return titles.where(~is_front_matter(F.col("title")))


def limited_run(leaves: DataFrame, max_chapters: int = 3, max_sections: int = 5, start_chapter: int = 1, skip_front_matter: bool = False) -> DataFrame:
    """The first leaves of the first chapters: front matter goes, then the offset and the two limits hold."""
    chosen = leaves.where(~is_front_matter(F.col("chapter_title"))) if skip_front_matter else leaves
    chapter = F.dense_rank().over(Window.partitionBy("book_id").orderBy("chapter_number"))
    section = F.row_number().over(Window.partitionBy("book_id", "chapter_number").orderBy("toc_idx"))
    chosen = chosen.withColumns({"chapter_rank": chapter, "section_rank": section})
    return chosen.where((F.col("chapter_rank") >= start_chapter) & (F.col("chapter_rank") < start_chapter + max_chapters) & (F.col("section_rank") <= max_sections))


def chapter_page_ranges(tree: DataFrame, pages: DataFrame) -> DataFrame:
    """Chapters with first and last page: up to the page of the next entry of their level, or the book's last."""
    last = pages.groupBy("book_id").agg(F.max("page_num").alias("last_page"))
    follow = F.lead("page").over(Window.partitionBy("book_id").orderBy("toc_idx"))
    chapters = tree.where("level = 1").select("book_id", "chapter_number", "title", F.col("page").alias("start_page"), follow.alias("next_page"))
    return chapters.join(last, "book_id", "left").select("book_id", "chapter_number", "title", "start_page", F.coalesce("next_page", "last_page").cast("int").alias("end_page"))
