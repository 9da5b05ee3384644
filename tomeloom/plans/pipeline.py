"""From pages, outline and metadata to chunks and key ideas: the composition of all operators."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, EngineConfig
from ..operators import chunking, concepts, dedup, hierarchy, progress, reports, store
from ..schemas import key_id
from ..session import stored
from ..sources import books as sources
from ..sources.books import normalize_meta, normalize_toc
from ..sources.snapshots import Snapshot, Store


@dataclass
class Book:
    """Lazy tables of one run; each is a DataFrame over all books."""

    pages: DataFrame
    raw_toc: DataFrame
    raw_meta: DataFrame
    config: EngineConfig = DEFAULT
    splitter: object = None
    concept_model: object = None
    answers: str | None = None  # a path for what the concept model says, so that later runs don't ask it again
    chat: object = None  # a factory of chat models: asked with the package's prompts where splitter and concept_model are unset

    def __post_init__(self):
        if self.chat:
            self.splitter = self.splitter or concepts.Prompted(self.chat, concepts.SPLIT_PROMPT)
            asked = concepts.Prompted(self.chat, concepts.IDEA_PROMPT)
            self.concept_model = self.concept_model or (lambda: asked)

    @classmethod
    def from_pdf(cls, spark: SparkSession, path: str, **options) -> Book:
        """All PDF files under path, read by the workers. (For pages in slices of long files, on paths that pyarrow reads, see sources/pdf.py.)"""
        return cls(sources.pdf_pages(spark, path), sources.pdf_outline(spark, path), sources.pdf_meta(spark, path), **options)

    @cached_property
    def toc(self) -> DataFrame:
        return normalize_toc(self.raw_toc)

    @cached_property
    def meta(self) -> DataFrame:
        return normalize_meta(self.raw_meta)

    @cached_property
    def tree(self) -> DataFrame:
        """The nested outline, stored: each table of a run needs it."""
        return stored(hierarchy.structure(self.toc, self.pages, self.config), "tree")

    @cached_property
    def leaves(self) -> DataFrame:
        """Leaf sections with their content, stored."""
        return stored(hierarchy.with_content(hierarchy.leaf_sections(self.tree), self.pages, self.config), "leaves")

    @cached_property
    def chunks(self) -> DataFrame:
        """Stored, so that a model is asked once and no consumer cuts the texts again."""
        return stored(chunking.chunks_build(self.leaves, self.splitter, self.config), "chunks")

    @cached_property
    def extracted(self) -> DataFrame:
        """Chunks with their concept; stored where a model gives it."""
        made = concepts.concept_extract(self.chunks, self.concept_model, config=self.config, answers=self.answers)
        return stored(made, "ideas") if self.concept_model else made

    @cached_property
    def ideas(self) -> DataFrame:
        """Chunks with concept and is_duplicate (within the book)."""
        return dedup.mark_duplicates(self.extracted, ["book_id"])

    @cached_property
    def kept(self) -> DataFrame:
        """The first chunk of each concept, and chunks without one."""
        return dedup.dedup_within_book(self.extracted)

    def without_toc(self) -> DataFrame:
        """Books that have no outline, or one that can't be read, with the error that stops them."""
        none = self.meta.join(self.toc.select("book_id").distinct(), "book_id", "left_anti").select("book_id", F.lit("no outline").alias("error"))
        return none.unionByName(hierarchy.bad_outlines(self.toc))

    @cached_property
    def books(self) -> DataFrame:
        return stored(store.books_build(self.meta), "books")

    def chapters(self) -> DataFrame:
        """Chapters with their first and last page."""
        ranges = hierarchy.chapter_page_ranges(self.tree, self.pages).select("book_id", "chapter_number", "start_page", "end_page")
        return store.chapters_build(self.tree).join(ranges, ["book_id", "chapter_number"], "left")

    def outcomes(self, rows: DataFrame) -> DataFrame:
        """book_id, chapter_id, status and error_message of all chapters, by rows (chunks with their errors): failed if a model failed on one of its chunks."""
        errors = rows.where("error is not null").groupBy("book_id", key_id("book_id", "chapter_idx").alias("chapter_id")).agg(F.min("error").alias("error_message"))
        all_ = store.chapters_build(self.tree).select("book_id", F.col("id").alias("chapter_id"))
        status = F.when(F.col("error_message").isNotNull(), "failed").otherwise("completed")
        return all_.join(errors, ["book_id", "chapter_id"], "left").withColumn("status", status)

    def tables(self) -> dict[str, DataFrame]:
        """The rows of all tables that a save writes; processing_progress as of one attempt."""
        events = self.outcomes(self.extracted).select("*", F.array(F.lit("processing"), F.col("status")).alias("both")).select("book_id", "chapter_id", "error_message", F.posexplode("both").alias("seq", "status"))
        events = events.select("book_id", "chapter_id", F.col("seq").cast("long").alias("seq"), "status", "error_message", F.current_timestamp().alias("at"), F.lit("").alias("writer"), F.lit("chapter").alias("processing_unit"))
        return {
            "books": self.books, "chapters": self.chapters(), "sections": store.sections_build(self.tree), "paragraph_chunks": store.chunks_persisted(self.kept),
            "key_ideas": store.key_ideas_build(self.kept), "processing_progress": progress.latest(events),
        }

    def stats(self) -> DataFrame:
        return reports.run_stats(self.tree, self.leaves, self.ideas)

    def summary(self) -> DataFrame:
        return reports.run_summary(self.stats())

    def only(self, ids: DataFrame) -> Book:
        """This run with the books of ids (book_id) alone."""
        keep = lambda rows: rows.join(ids, "book_id", "left_semi")
        return replace(self, pages=keep(self.pages), raw_toc=keep(self.raw_toc), raw_meta=keep(self.raw_meta))

    def refused(self, target: Store, at: Snapshot | None = None) -> DataFrame:
        """books that can't be saved: their title is stored, or a book of smaller id in this run has it."""
        known = target.table("books", at).select("title")
        return self.books.join(known, "title", "left_semi").unionByName(store.repeated_titles(self.books)).select(*self.books.columns).distinct()

    def _check(self, target: Store):
        """For a commit: a ValueError if a title is stored, by this state or by another writer meanwhile."""

        def check(at: Snapshot) -> None:
            titles = sorted(r.title for r in self.refused(target, at).select("title").distinct().limit(5).collect())
            if titles:
                raise ValueError(f"stored already, or twice in this run: {', '.join(titles)}")

        return check

    def save(self, path: str, repeated: str = "error", buckets: int = 64) -> DataFrame:
        """Save all tables in one commit; the books that were left out.

        A title that is stored, or that two books of this run have, is a ValueError before anything is written; with repeated="skip" such books are left out, with all that is theirs
        (of books of one title in this run the one of least id is saved). A run that stops leaves nothing that a reader sees, so it can be started again.
        """
        if repeated not in ("error", "skip"):
            raise ValueError(f"repeated is error or skip, not {repeated}")
        target = Store(self.pages.sparkSession, path, buckets)
        out = stored(self.refused(target), "refused")
        mine = self
        if repeated == "skip" and out.head(1):
            mine = self.only(stored(self.books.join(out.select("id"), "id", "left_anti").select(F.col("id").alias("book_id")), "book-ids"))
        else:
            self._check(target)(target.snapshot())
        target.save(mine.tables(), check=mine._check(target))
        return out

    def resume(self, path: str, steps: int = 1, writer: str = "run", buckets: int = 64) -> DataFrame:
        """Work off the chapters that aren't completed yet, in so many steps; then save the books that have none left. The state of all chapters.

        Each step marks its chapters as in processing, and then writes their chunks with concepts and marks them completed (or failed) in one commit. So a run that stopped goes on
        after its last step, and chapters that are completed are asked no model again. Failed chapters are tried again by later runs, up to retry_attempts times; then
        their book is saved without what failed. Two runs at once may do a chapter twice, and lose nothing: staged rows of equal ids count once.
        """
        spark, target = self.pages.sparkSession, Store(self.pages.sparkSession, path, buckets)
        unsaved = self.books.join(target.table("books").select("title"), "title", "left_anti").select(F.col("id").alias("book_id"))
        chapters = stored(store.chapters_build(self.tree).join(unsaved, "book_id", "left_semi").select("book_id", F.col("id").alias("chapter_id"), "chapter_number"), "chapters")

        def state() -> DataFrame:
            return stored(progress.latest(target.table("progress_events")), "progress")

        def mark(units: DataFrame, now: DataFrame, **more: DataFrame) -> None:
            target.save({"progress_events": progress.events_of(units, now, writer), **more})

        now = state()
        fresh = chapters.join(now, ["book_id", "chapter_id"], "left_anti")
        mark(fresh.select("book_id", "chapter_id", F.lit("pending").alias("status")), now)
        now = state()
        settled = now.where((F.col("status") == "completed") | (F.col("status") == "failed") & (F.col("attempt_count") >= self.config.retry_attempts))
        todo = stored(chapters.join(settled, ["book_id", "chapter_id"], "left_anti").withColumn("step", F.pmod(F.xxhash64("chapter_id"), F.lit(steps))), "todo")
        for step in [r.step for r in todo.select("step").distinct().orderBy("step").collect()]:
            mine = todo.where(F.col("step") == step)
            mark(mine.select("book_id", "chapter_id", F.lit("processing").alias("status")), now)
            now = state()
            leaves = self.leaves.join(mine.select("book_id", "chapter_number"), ["book_id", "chapter_number"], "left_semi")
            chunks = stored(chunking.chunks_build(leaves, self.splitter, self.config), "chunks")
            made = stored(concepts.concept_extract(chunks, self.concept_model, config=self.config, answers=self.answers), "ideas")
            done = stored(self.outcomes(made).join(mine.select("book_id", "chapter_id"), ["book_id", "chapter_id"], "left_semi"), "outcomes")
            last_try = now.where(F.col("attempt_count") >= self.config.retry_attempts).select("book_id", "chapter_id")
            keep = done.where("status = 'completed'").select("book_id", "chapter_id").union(done.where("status = 'failed'").select("book_id", "chapter_id").join(last_try, ["book_id", "chapter_id"], "left_semi"))
            rows = made.withColumns({"id": F.col("chunk_id"), "chapter_id": key_id("book_id", "chapter_idx")}).join(keep, ["book_id", "chapter_id"], "left_semi")
            mark(done, now, staged_ideas=rows)
            now = state()
        waiting = now.where((F.col("status") != "completed") & ~((F.col("status") == "failed") & (F.col("attempt_count") >= self.config.retry_attempts))).select("book_id").distinct()
        ready = stored(unsaved.join(waiting, "book_id", "left_anti"), "ready")
        if ready.head(1):
            ready_run = self.only(ready)
            order = Window.partitionBy("book_id").orderBy("chapter_number", "toc_idx", "section_paragraph_index")
            rows = target.table("staged_ideas").join(ready, "book_id", "left_semi").dropDuplicates(["id"]).withColumn("book_paragraph_index", F.row_number().over(order) - 1).withColumnRenamed("id", "chunk_id")
            kept = stored(dedup.dedup_within_book(stored(rows, "staged")), "kept")
            tables = {"books": ready_run.books, "chapters": ready_run.chapters(), "sections": store.sections_build(ready_run.tree), "paragraph_chunks": store.chunks_persisted(kept), "key_ideas": store.key_ideas_build(kept)}
            target.save(tables | {"processing_progress": now.join(ready, "book_id", "left_semi")}, check=ready_run._check(target))
        return now
