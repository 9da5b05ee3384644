"""One query for each operator, over the test tables: conversations are books, turns pages."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions import text as T
from ..operators import chunking, concepts, dedup, hierarchy, near_vectors, pages, progress, reports, store
from ..session import shared_dir, ship, stored
from ..sources import books as src
from ..sources.snapshots import Store
from .pipeline import Book

QUERIES: dict = {}


def query(f):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


def book(spark, d) -> Book:
    p = src.conversation_pages(spark, d)
    return Book(p, src.outline_of(p), src.conversation_meta(p))


def documents(spark, d) -> DataFrame:
    return src.table(spark, d, "documents").select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"))


def doc_paragraphs(spark, d) -> DataFrame:
    return documents(spark, d).select("doc_id", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("content"))


def doc_ideas(spark, d) -> DataFrame:
    """Documents as chunks: the book is the source, the order doc_id."""
    rows = documents(spark, d).select(F.regexp_extract("source", r"(\d+)", 1).cast("long").alias("book_id"), F.col("doc_id").alias("chunk_id"), F.col("text").alias("paragraph"))
    return concepts.concept_extract(rows).drop("error", "paragraph")


def states(spark, d) -> DataFrame:
    events = src.table(spark, d, "events")
    kinds = ["click", "signup", "purchase"]
    status = F.when(F.col("event_type") == kinds[0], "processing").when(F.col("event_type") == kinds[1], "failed").when(F.col("event_type") == kinds[2], "completed").otherwise("pending")
    return progress.transition(events.select(F.col("user_id").alias("book_id"), (F.col("event_id") % 4).cast("int").alias("unit_id"), F.col("event_id").alias("seq"), status.alias("status"), F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("error")))


# --- sources and pages


@query
def page_lookup(spark, d):
    return pages.page_lookup(src.conversation_pages(spark, d), 3, 1)


@query
def page_scan(spark, d):
    return src.conversation_pages(spark, d).orderBy("book_id", "page_num")


@query
def page_count(spark, d):
    return pages.page_count(src.conversation_pages(spark, d))


@query
def book_metadata(spark, d):
    return book(spark, d).meta


@query
def toc_normalize(spark, d):
    return book(spark, d).toc


@query
def full_text_raw(spark, d):
    return pages.book_text(src.conversation_pages(spark, d), normalize=False)


@query
def full_text_normalized(spark, d):
    return pages.book_text(src.conversation_pages(spark, d))


@query
def page_positions(spark, d):
    return pages.page_positions(src.conversation_pages(spark, d)).drop("text")


@query
def page_positions_aligned(spark, d):
    return pages.normalized_pages(src.conversation_pages(spark, d)).select("book_id", "page_num", "start_char", "end_char")


@query
def sample_lookup(spark, d):
    return src.sample_at(spark, src.table(spark, d, "nation").select((F.col("n_nationkey") - 7).cast("int").alias("index")))


# --- text


@query
def truncate_text(spark, d):
    return documents(spark, d).select("doc_id", T.truncate(F.col("text")).alias("text"), T.dropped_chars(F.col("text")).cast("long").alias("dropped_chars"))


@query
def marker_position(spark, d):
    exact = F.substring("text", 101, 30)
    marker = F.when(F.col("doc_id") % 4 == 0, exact).when(F.col("doc_id") % 4 == 1, F.replace(exact, F.lit(" "), F.lit("  "))).when(F.col("doc_id") % 4 == 2, "no such marker").otherwise("")
    return documents(spark, d).select("doc_id", T.marker_position(F.col("text"), marker).alias("position"))


@query
def chunk_preview(spark, d):
    return documents(spark, d).select("doc_id", T.preview(F.col("text")).alias("preview"))


@query
def hierarchy_path_simple(spark, d):
    return src.table(spark, d, "part").select("p_partkey", T.hierarchy_path(F.col("p_brand"), F.when(F.col("p_size") % 2 == 0, F.col("p_type")).otherwise("")).alias("path"))


@query
def front_matter_filter(spark, d):
    n = F.element_at(F.array(*[F.lit(x) for x in FRONT_TITLES]), (F.col("n_nationkey") % len(FRONT_TITLES) + 1).cast("int"))
    return hierarchy.front_matter_filter(src.table(spark, d, "nation").select("n_nationkey", n.alias("title")))


FRONT_TITLES = ["Cover", " copyright page", "Uncovered", "About the Author", "Chapter 1", "INTRODUCTION to it", "A Preface", "Dedication", "Contents", "The contents"]


# --- hierarchy


@query
def toc_char_positions(spark, d):
    b = book(spark, d)
    return hierarchy.toc_char_positions(b.toc, b.pages)


@query
def toc_char_positions_reference(spark, d):
    b = book(spark, d)
    shifted = b.toc.withColumn("page", F.col("page") + F.when(F.col("toc_idx") % 5 == 4, 100).otherwise(0))
    return hierarchy.toc_char_positions(shifted, b.pages, DEFAULT.updated(offset_mode="reference"))


@query
def chapter_spans(spark, d):
    return hierarchy.chapter_spans(book(spark, d).tree)


@query
def section_spans(spark, d):
    return hierarchy.section_spans(book(spark, d).tree)


@query
def section_parents(spark, d):
    return hierarchy.section_parents(book(spark, d).tree)


@query
def section_counts(spark, d):
    return hierarchy.section_counts(book(spark, d).tree)


@query
def leaf_sections(spark, d):
    return hierarchy.leaf_sections(book(spark, d).tree).drop("chapter_idx")


@query
def section_contents(spark, d):
    return book(spark, d).leaves.select("book_id", "toc_idx", "content")


@query
def eligible_sections(spark, d):
    return chunking.eligible_sections(book(spark, d).leaves).select("book_id", "toc_idx", "hierarchy_path", F.length("content").cast("long").alias("n_chars"))


@query
def limited_run(spark, d):
    return hierarchy.limited_run(hierarchy.leaf_sections(book(spark, d).tree), max_chapters=1, max_sections=1, start_chapter=2).select("book_id", "chapter_number", "toc_idx", "chapter_rank", "section_rank")


@query
def chapter_page_ranges(spark, d):
    b = book(spark, d)
    return hierarchy.chapter_page_ranges(b.tree, b.pages)


@query
def structure_tree(spark, d):
    return reports.structure_tree(book(spark, d).tree)


@query
def books_without_toc(spark, d):
    b = book(spark, d)
    return Book(b.pages, b.raw_toc.where("book_id % 4 <> 0"), b.raw_meta).without_toc()


# --- chunking


@query
def paragraphs_rule_split(spark, d):
    return chunking.paragraphs_rule_split(doc_paragraphs(spark, d))


@query
def paragraphs_split(spark, d):
    return chunking.split_paragraphs(book(spark, d).leaves.select("book_id", "toc_idx", "content")).drop("position_exact")


def _halves(text: str) -> str:
    """A stand-in for a model: two halves, and no answer for some texts."""
    import json

    half = len(text) // 2
    if len(text) % 7 == 0:
        return "no JSON"
    return json.dumps({"paragraphs": [{"text": t, "start_marker": t[:30]} for t in (text[:half], text[half:])]})


@query
def paragraphs_split_model(spark, d):
    return chunking.split_paragraphs(book(spark, d).leaves.select("book_id", "toc_idx", "content"), _halves).select("book_id", "toc_idx", "method", "paragraph_index", "paragraph")


def _loose_halves(text: str) -> str:
    """A stand-in for a model that doesn't keep white space: two halves, all runs of it doubled."""
    import json
    import re

    half = len(text) // 2
    return json.dumps({"paragraphs": [{"text": re.sub(r"\s+", "\n ", t), "start_marker": ""} for t in (text[:half], text[half:])]})


@query
def paragraphs_split_aligned(spark, d):
    """Exact spans for pieces with changed white space."""
    leaves = book(spark, d).leaves.select("book_id", "toc_idx", "content")
    return chunking.split_paragraphs(leaves, _loose_halves, config=DEFAULT.updated(align_pieces=True))


@query
def chunks_greedy_merge(spark, d):
    return chunking.chunks_greedy_merge(pages.book_text(src.conversation_pages(spark, d)).withColumnRenamed("full_text", "content"))


@query
def sentence_chunks(spark, d):
    return chunking.sentence_chunks(documents(spark, d).select("doc_id", F.col("text").alias("content")))


@query
def chunks_build(spark, d):
    return book(spark, d).chunks.select("book_id", "chapter_number", "toc_idx", "hierarchy_path", "section_paragraph_index", "chapter_paragraph_index", "book_paragraph_index", "paragraph", "method")


@query
def chunk_quality(spark, d):
    b = book(spark, d)
    return reports_quality(b)


def reports_quality(b):
    return chunking.chunk_quality(b.chunks, b.leaves).withColumn("section_chars", F.col("section_chars").cast("long"))


# --- concepts and dedup


@query
def concept_extract(spark, d):
    return doc_ideas(spark, d)


@query
def json_parse(spark, d):
    k = F.col("doc_id") % 5
    good = F.to_json(F.struct(F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("concept")))
    reply = F.when(k == 0, good).when(k == 1, "not json").when(k == 2, "{}").when(k == 3, '{"paragraphs":[]}').otherwise('{"paragraphs":[{"text":"a","concept":"b"},{"text":"c"}]}')
    return concepts.parse_replies(documents(spark, d).select("doc_id", reply.alias("reply"))).drop("reply")


def _order():
    return ["chunk_id"]


@query
def dedup_within_book(spark, d):
    return dedup.dedup_within_book(stored(doc_ideas(spark, d), "ideas"), _order())


@query
def dedup_global(spark, d):
    return dedup.dedup_global(stored(doc_ideas(spark, d), "ideas"), _order())


@query
def dedup_against_store(spark, d):
    ideas = stored(doc_ideas(spark, d), "ideas")
    known = ideas.where("chunk_id % 3 = 0").select("book_id", F.col("concept").alias("core_idea_text"))
    return dedup.dedup_against_store(ideas.where("chunk_id % 3 <> 0"), known).select("book_id", "chunk_id", "concept")


@query
def duplicates_skipped(spark, d):
    return dedup.duplicates_skipped(stored(doc_ideas(spark, d), "ideas"), _order())


@query
def near_dup_cosine(spark, d):
    return dedup.near_dup_cosine(src.table(spark, d, "embeddings"), 0.4)


@query
def idea_groups(spark, d):
    vectors = src.table(spark, d, "embeddings")
    pairs = dedup.near_dup_cosine(vectors, 0.4, spanning=True)
    return dedup.idea_groups(pairs, vectors.select(F.col("vec_id").alias("id"), F.concat(F.lit("idea "), F.col("vec_id").cast("string")).alias("core_idea_text")))


@query
def idea_groups_index(spark, d):
    """Groups of vectors of cosine 0.9 or more, by the index: each embedding with a bent copy of it."""
    x = src.table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    bent = F.transform("embedding", lambda v, i: v * (1 + 0.3 * ((i + F.col("vec_id")) % 3 - 1)))
    both = stored(x.union(x.select(F.col("vec_id") + 1_000_000, bent)), "bent")
    links = near_vectors.near_links(both, 0.9)
    return dedup.idea_groups(links.select("vec_a", "vec_b"), both.select(F.col("vec_id").alias("id"), F.concat(F.lit("idea "), F.col("vec_id").cast("string")).alias("core_idea_text")))


def hash_vector(text: Column) -> Column:
    """The 64 bytes of a text's SHA-512, about zero: texts that differ are never near. (Of some thousand texts, some pairs of vectors of 16 bytes have a cosine over 0.9.)"""
    digest = F.sha2(text, 512)
    return F.transform(F.sequence(F.lit(1), F.lit(127), F.lit(2)), lambda i: F.conv(F.substring(digest, i, F.lit(2)), 16, 10).cast("double") - 127.5)


@query
def stored_idea_groups(spark, d):
    """Saved ideas grouped by vectors, in two runs of which the second finds the first one's groups; the concept's hash stands in for an embedding."""
    s = Store(spark, f"{shared_dir(spark)}/store-{uuid.uuid4().hex}", BUCKETS)
    book(spark, d).save(s.path)
    vectors = s.table("key_ideas").select("id", "book_id", hash_vector(F.col("core_idea_text")).alias("vector"))
    near_vectors.save_groups(s, vectors.where("book_id % 2 = 0"))
    near_vectors.save_groups(s, vectors)
    at = s.snapshot()
    members = s.table("key_ideas", at).groupBy(F.col("idea_group_id").alias("id")).agg(F.count("*").alias("members"))
    return s.table("idea_groups", at).join(members, "id").select("canonical_idea_text", "members")


# --- store


@query
def books_build(spark, d):
    return store.books_build(book(spark, d).meta)


@query
def book_exists(spark, d):
    made = store.books_build(book(spark, d).meta)
    return store.book_exists(made, made.where("id % 2 = 0"))


@query
def chapters_build(spark, d):
    return store.chapters_build(book(spark, d).tree).drop("id")


@query
def sections_build(spark, d):
    return store.sections_build(book(spark, d).tree).drop("id", "chapter_id", "parent_section_id")


@query
def section_title_map(spark, d):
    return store.section_title_map(store.sections_build(book(spark, d).tree))


@query
def section_next_number(spark, d):
    tree = book(spark, d).tree
    return store.section_next_number(store.chapters_build(tree), store.sections_build(tree))


@query
def section_get_or_create(spark, d):
    made = store.sections_build(book(spark, d).tree)
    wanted = made.select("book_id", "chapter_number", "title").union(made.select("book_id", "chapter_number", F.concat(F.lit("new "), F.col("title"))))
    return store.section_get_or_create(made, wanted)


@query
def parent_section_lookup(spark, d):
    tree = book(spark, d).tree
    wanted = hierarchy.section_parents(tree).join(tree.select("book_id", "toc_idx", "chapter_number"), ["book_id", "toc_idx"])
    return store.parent_section_lookup(wanted, store.sections_build(tree))


@query
def chunks_persisted(spark, d):
    return store.chunks_persisted(book(spark, d).kept).drop("id", "chapter_id", "section_id")


@query
def key_ideas_build(spark, d):
    return store.key_ideas_build(book(spark, d).kept).drop("id", "chunk_id")


BUCKETS = 8  # of the stores that queries make: the test tables hold few books
_stores: dict = {}


def saved(spark, d) -> Store:
    """The tables of all books as saved, once for each application and folder."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _stores:
        path = f"{shared_dir(spark)}/store-{uuid.uuid4().hex}"
        book(spark, d).save(path, buckets=BUCKETS)
        _stores[key] = Store(spark, path)
    return _stores[key]


def stored_id(found: DataFrame) -> int:
    """The id of the one row found; one that nothing has if there is none."""
    row = found.select("id").first()
    return row.id if row else -1


@query
def book_by_id(spark, d):
    return saved(spark, d).lookup("books", id=5).select("id", "title", "author", "source_path")


@query
def book_by_title(spark, d):
    return saved(spark, d).lookup("books", title="Book 7").select("id", "title", "author", "source_path")


@query
def chunks_by_book(spark, d):
    return saved(spark, d).lookup("paragraph_chunks", ["page_number", "paragraph_index"], book_id=5).select("book_id", "page_number", "toc_idx", "paragraph_index", "body_text")


@query
def ideas_by_book(spark, d):
    s = saved(spark, d)
    chunks = s.lookup("paragraph_chunks", book_id=5).select(F.col("id").alias("chunk_id"), "toc_idx")
    return s.lookup("key_ideas", book_id=5).join(chunks, "chunk_id").select("book_id", "toc_idx", "core_idea_text")


CHAPTER = ["book_id", "chapter_number", "title", "level", "detection_method", "start_page", "end_page"]


@query
def chapters_by_book(spark, d):
    return saved(spark, d).lookup("chapters", ["chapter_number"], book_id=5).select(*CHAPTER)


@query
def chapter_by_id(spark, d):
    s = saved(spark, d)
    return s.lookup("chapters", id=stored_id(s.lookup("chapters", book_id=5, chapter_number=2))).select(*CHAPTER)


@query
def chunks_by_chapter(spark, d):
    s = saved(spark, d)
    chapter = stored_id(s.lookup("chapters", book_id=5, chapter_number=1))
    return s.lookup("paragraph_chunks", ["chapter_paragraph_index"], chapter_id=chapter).select("book_id", "chapter_paragraph_index", "body_text")


@query
def sections_by_chapter(spark, d):
    s = saved(spark, d)
    chapter = s.lookup("chapters", book_id=5, chapter_number=1)
    sections = s.lookup("sections", chapter_id=stored_id(chapter)).join(chapter.select(F.col("id").alias("chapter_id"), "chapter_number"), "chapter_id")
    return sections.orderBy("section_number").select("book_id", "chapter_number", "section_number", "title")


@query
def section_by_id(spark, d):
    s = saved(spark, d)
    chapter = stored_id(s.lookup("chapters", book_id=5, chapter_number=1))
    return s.lookup("sections", id=stored_id(s.lookup("sections", chapter_id=chapter, section_number=2))).select("book_id", "section_number", "title", "level")


@query
def chunks_by_section(spark, d):
    s = saved(spark, d)
    chapter = stored_id(s.lookup("chapters", book_id=5, chapter_number=1))
    section = stored_id(s.lookup("sections", chapter_id=chapter, section_number=2))
    return s.lookup("paragraph_chunks", ["chapter_paragraph_index"], section_id=section).select("book_id", "chapter_paragraph_index", "body_text")


@query
def stored_chunks(spark, d):
    """Each saved chunk with its book, chapter, section and idea, found by the keys that are stored."""
    s = saved(spark, d)
    at = s.snapshot()
    chunks = s.table("paragraph_chunks", at).select(F.col("id").alias("chunk_id"), "book_id", "chapter_id", "section_id", "page_number", "paragraph_index", "chapter_paragraph_index", F.length("body_text").cast("long").alias("n_chars"))
    books = s.table("books", at).select(F.col("id").alias("book_id"), F.col("title").alias("book_title"))
    chapters = s.table("chapters", at).select(F.col("id").alias("chapter_id"), "chapter_number", F.col("title").alias("chapter_title"))
    sections = s.table("sections", at).select(F.col("id").alias("section_id"), "section_number", F.col("title").alias("section_title"))
    ideas = s.table("key_ideas", at).select("chunk_id", "core_idea_text")
    return chunks.join(books, "book_id").join(chapters, "chapter_id").join(sections, "section_id", "left").join(ideas, "chunk_id").drop("chunk_id", "chapter_id", "section_id")


@query
def stored_chapters(spark, d):
    """Saved chapters with their pages and the state of their work."""
    s = saved(spark, d)
    at = s.snapshot()
    state = s.table("processing_progress", at).select("chapter_id", "status", "attempt_count", "processing_unit")
    return s.table("chapters", at).withColumnRenamed("id", "chapter_id").join(state, "chapter_id").select(*CHAPTER, "status", "attempt_count", "processing_unit")


@query
def stored_after_delete(spark, d):
    """What is left in the store of each book after the chapters of book 5 and a section of book 7 went, with all that hangs on them."""
    s = Store(spark, f"{shared_dir(spark)}/store-{uuid.uuid4().hex}", BUCKETS)
    book(spark, d).save(s.path)  # the store has its buckets already
    s.delete("chapters", cascade=True, book_id=5)
    s.delete("sections", cascade=True, book_id=7, section_number=2)
    at = s.snapshot()
    count = lambda name: s.table(name, at).groupBy("book_id").agg(F.count("*").alias(name))
    rows = s.table("books", at).select(F.col("id").alias("book_id"))
    for name in ("chapters", "sections", "paragraph_chunks", "key_ideas", "processing_progress"):
        rows = rows.join(count(name), "book_id", "left")
    return rows.na.fill(0)


@query
def resumed_run(spark, d):
    """Key ideas saved by a run that marks its chapters' progress and goes by steps."""
    path = f"{shared_dir(spark)}/store-{uuid.uuid4().hex}"
    book(spark, d).resume(path, buckets=BUCKETS)
    s = Store(spark, path)
    chunks = s.table("paragraph_chunks").select(F.col("id").alias("chunk_id"), "paragraph_index")
    return s.table("key_ideas").join(chunks, "chunk_id").select("book_id", "paragraph_index", "core_idea_text")


@query
def delete_chapters_by_book(spark, d):
    chapters = store.chapters_build(book(spark, d).tree).drop("id")
    return store.delete_where(chapters, chapters.where("book_id % 10 = 0").select("book_id").distinct(), ["book_id"])[0]


@query
def delete_sections_by_chapter(spark, d):
    sections = store.sections_build(book(spark, d).tree)
    return store.delete_where(sections, sections.where("book_id = 5 and chapter_number = 1").select("book_id", "chapter_number").distinct(), ["book_id", "chapter_number"])[1]


# --- progress and reports


@query
def progress_transition(spark, d):
    return states(spark, d)


@query
def progress_init(spark, d):
    begun = book(spark, d).tree.where("level = 1 and book_id % 2 = 0").select("book_id", F.lit("chapter").alias("processing_unit"))
    return progress.progress_init(store.chapters_build(book(spark, d).tree), begun)


@query
def pending_chapters(spark, d):
    return progress.pending(store.chapters_build(book(spark, d).tree), states(spark, d)).drop("id")


@query
def chapters_remaining(spark, d):
    return progress.remaining(store.chapters_build(book(spark, d).tree), states(spark, d)).drop("id")


@query
def progress_stats(spark, d):
    return progress.progress_stats(states(spark, d))


@query
def progress_reset_stuck(spark, d):
    return progress.reset_stuck(states(spark, d)).select("book_id", "unit_id", "status", "was_reset")


@query
def book_processed(spark, d):
    return progress.book_processed(states(spark, d))


@query
def run_stats(spark, d):
    return book(spark, d).stats()


@query
def run_summary(spark, d):
    return book(spark, d).summary()


@query
def concept_counts(spark, d):
    return reports.concept_counts(book(spark, d).ideas)


@query
def inspection_report(spark, d):
    kept = book(spark, d).kept
    return reports.inspection_report(states(spark, d), store.chunks_persisted(kept), store.key_ideas_build(kept))


@query
def result_tree_json(spark, d):
    return reports.result_tree_json(book(spark, d).ideas)


@query
def section_forward_fill(spark, d):
    title = F.when(F.col("page_num") % 3 == 1, F.left("text", F.lit(12))).when(F.col("page_num") % 3 == 2, "NULL")
    rows = src.conversation_pages(spark, d).select("book_id", "page_num", title.alias("title"))
    return reports.section_forward_fill(rows, "title", "book_id", "page_num")


@query
def table_run_filter_whole(spark, d):
    lines = documents(spark, d).select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    shaped = lines.withColumn("line", F.when(F.col("line_no") % 7 < 3, F.concat(F.lit("| "), "line", F.lit(" |"))).otherwise(F.col("line")))
    return reports.table_run_filter(shaped, "doc_id", "line_no")


@query
def table_run_filter(spark, d):
    lines = documents(spark, d).select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    shaped = lines.withColumn("line", F.when(F.col("line_no") % 7 < 3, F.concat(F.lit("| "), "line", F.lit(" |"))).otherwise(F.col("line")))
    return reports.table_run_filter(shaped, "doc_id", "line_no")


@query
def heading_chapters(spark, d):
    lines = src.table(spark, d, "part").select("p_partkey", F.concat(F.when(F.col("p_size") % 3 == 0, "Chapter ").when(F.col("p_size") % 3 == 1, "part ").otherwise("Chapters "), F.col("p_size").cast("string")).alias("line"))
    return reports.heading_chapters(lines)
