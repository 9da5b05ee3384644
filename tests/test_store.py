"""The stored tables: one commit for each save, runs that stop, several writers, lookups, deletes, progress."""

import json

import pytest
from pyspark.sql import functions as F

from tests.test_run_and_sources import TOC, plain_book
from tomeloom.config import DEFAULT
from tomeloom.operators import progress
from tomeloom.plans import queries
from tomeloom.plans.pipeline import Book
from tomeloom.schemas import TABLES, book_bucket, init_tables, key_id
from tomeloom.sources.snapshots import Conflict, Store
from tomeloom.streaming.track import track

SF = "/root/testdata/sf0.001"
WORDS = "One Intro words and more of them. " * 6


def many_books(spark, n=12, **options):
    """Books of two chapters, the second one with two sections; each text names its place."""
    pages = [(b, i, f"book{b:02d} page {i} Word{chr(97 + i)}{chr(97 + b)} {WORDS}") for b in range(n) for i in range(4)]
    toc = [(b, i, level, f"t{i}", i + 1) for b in range(n) for i, level in enumerate([1, 1, 2, 2])]
    meta = [(b, f"Title {b}", None, f"/x/{b}.pdf", 4) for b in range(n)]
    return Book(spark.createDataFrame(pages, "book_id long, page_num int, text string"), spark.createDataFrame(toc, TOC), spark.createDataFrame(meta, "book_id long, title string, author string, source_path string, total_pages int"), **options)


def counts(store):
    at = store.snapshot()
    return {n: store.table(n, at).count() for n in ("books", "chapters", "sections", "paragraph_chunks", "key_ideas", "processing_progress")}


@pytest.fixture(scope="module")
def saved(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store") / "all")
    many_books(spark).save(path, buckets=8)
    return Store(spark, path)


ALL = {"books": 12, "chapters": 24, "sections": 24, "paragraph_chunks": 36, "key_ideas": 36, "processing_progress": 24}


def test_keys_of_saved_rows(saved):
    assert counts(saved) == ALL
    chunks, ideas = saved.table("paragraph_chunks"), saved.table("key_ideas")
    chapters, sections = saved.table("chapters"), saved.table("sections")
    assert chunks.join(chapters, chunks.chapter_id == chapters.id).where(chunks.book_id == chapters.book_id).count() == 36
    assert chunks.where("section_id is null").count() == 12  # right under their chapter
    assert chunks.join(sections, chunks.section_id == sections.id).where(chunks.chapter_id == sections.chapter_id).count() == 24
    assert ideas.join(chunks, ideas.chunk_id == chunks.id).where(ideas.book_id == chunks.book_id).count() == 36
    assert {(r.start_page, r.end_page) for r in chapters.collect()} == {(0, 1), (1, 3)}
    state = saved.table("processing_progress")
    assert state.join(chapters, state.chapter_id == chapters.id).where("status = 'completed' and attempt_count = 1 and completed_at is not null").count() == 24
    assert all(saved.table(n).where("created_at is null").count() == 0 for n in ALL)


def test_a_save_that_stops_is_not_seen(spark, tmp_path, monkeypatch):
    path, book = str(tmp_path / "s"), many_books(spark, 3)
    store, stage, done = Store(spark, path, 4), Store.stage, []

    def stops(self, name, *rest):
        if len(done) == 3:
            raise RuntimeError("killed")
        done.append(name)
        return stage(self, name, *rest)

    monkeypatch.setattr(Store, "stage", stops)
    with pytest.raises(RuntimeError, match="killed"):
        book.save(path)
    monkeypatch.undo()
    assert store.snapshot().version == 0 and set(counts(store).values()) == {0}
    assert len(done) == 3 and store._names(f"{path}/{done[0]}")  # written, but part of nothing
    book.save(path)
    first = counts(store)
    assert first["books"] == 3 and first["paragraph_chunks"] == 9
    assert store.vacuum() > 0 and counts(store) == first and store.versions() == [1]
    with pytest.raises(ValueError, match="Title 0"):
        book.save(path)
    assert counts(store) == first and store.snapshot().version == 1


def test_titles_are_refused_once_for_each_book(spark, tmp_path):
    path = str(tmp_path / "s")
    book = many_books(spark, 4)
    twins = Book(book.pages, book.raw_toc, book.raw_meta.withColumn("title", F.when(F.col("book_id") < 2, "Twin").otherwise(F.col("title"))))
    with pytest.raises(ValueError, match="Twin"):
        twins.save(path, buckets=4)
    store = Store(spark, path)
    assert store.snapshot().version == 0
    assert [r.id for r in twins.save(path, repeated="skip").collect()] == [1]
    assert sorted(r.id for r in store.table("books").collect()) == [0, 2, 3] and counts(store)["paragraph_chunks"] == 9
    assert [r.id for r in twins.save(path, repeated="skip").orderBy("id").collect()] == [0, 1, 2, 3]
    assert counts(store)["books"] == 3
    with pytest.raises(ValueError, match="repeated"):
        twins.save(path, repeated="often")


def test_two_writers_of_one_title(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    store, publish, between = Store(spark, path, 4), Store._publish, []

    def slow(self, new):
        if not between:
            between.append(1)
            many_books(spark, 2).save(path)  # another writer is first
        return publish(self, new)

    monkeypatch.setattr(Store, "_publish", slow)
    with pytest.raises(ValueError, match="Title"):
        many_books(spark, 2).save(path)
    monkeypatch.undo()
    assert counts(store)["books"] == 2 and store.snapshot().version == 1


def test_appends_of_two_writers_both_count(spark, tmp_path, monkeypatch):
    store, publish, between = Store(spark, str(tmp_path / "s"), 4), Store._publish, []
    row = lambda i: spark.createDataFrame([(i, f"t{i}", "a", "p")], "id long, title string, author string, source_path string")

    def slow(self, new):
        if not between:
            between.append(1)
            store.append("books", row(2))
        return publish(self, new)

    monkeypatch.setattr(Store, "_publish", slow)
    store.append("books", row(1))
    assert {r.id for r in store.table("books").collect()} == {1, 2} and store.snapshot().version == 2
    store.append("books", row(1))
    assert store.table("books").count() == 2
    old = store.snapshot(1)
    assert store.table("books", old).count() == 1  # an older version stays as it was
    with pytest.raises(Conflict):
        store.commit({}, {"books": old.folders["books"] | {b: [] for b in range(4) if b not in old.folders["books"]}})


def test_rows_need_their_columns(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    with pytest.raises(ValueError, match="chapter_id"):
        store.save({"paragraph_chunks": spark.createDataFrame([(1, 1, "x")], "id long, book_id long, body_text string")})
    with pytest.raises(ValueError, match="power of two"):
        Store(spark, str(tmp_path / "t"), 12)
    init_tables(spark, str(tmp_path / "s"))  # leaves what is there
    assert all(store.table(n).count() == 0 and store.table(n).schema == TABLES[n] for n in TABLES)


def test_lookups_read_one_bucket(spark, saved):
    chapter = saved.lookup("chapters", book_id=5, chapter_number=2).first()
    section = saved.lookup("sections", ["section_number"], chapter_id=chapter.id).collect()
    assert [s.section_number for s in section] == [1, 2]
    b = spark.range(1).select(book_bucket(F.lit(5), 8)).first()[0]
    for name, equal in [("books", {"id": 5}), ("chapters", {"book_id": 5}), ("chapters", {"id": chapter.id}), ("sections", {"chapter_id": chapter.id}), ("sections", {"id": section[0].id}), ("paragraph_chunks", {"book_id": 5}), ("paragraph_chunks", {"chapter_id": chapter.id}), ("paragraph_chunks", {"section_id": section[1].id}), ("key_ideas", {"book_id": 5})]:
        found = saved.lookup(name, **equal)
        assert found.count() > 0 and all(f"bucket={b}/" in f for f in found.inputFiles()) and len(saved.table(name).inputFiles()) > len(found.inputFiles())
        column = next(iter(equal))
        assert "PushedFilters: [IsNotNull(" + column in found._jdf.queryExecution().explainString(found._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert saved.lookup("chapters", id=key_id_of(spark, 99, 0)).count() == 0
    assert saved.lookup("paragraph_chunks", book_id=4, chapter_id=chapter.id).count() == 0
    assert [r.id for r in saved.lookup("books", title="Title 3").collect()] == [3]


def key_id_of(spark, *parts):
    return spark.range(1).select(key_id(*[F.lit(p) for p in parts])).first()[0]


def test_deletes_leave_other_buckets_alone(spark, tmp_path):
    path = str(tmp_path / "s")
    many_books(spark).save(path, buckets=8)
    store = Store(spark, path)
    before, b = store.snapshot(), spark.range(1).select(book_bucket(F.lit(5), 8)).first()[0]
    assert store.delete("chapters", cascade=True, book_id=5) == 2
    at = store.snapshot()
    assert counts(store) == {"books": 12, "chapters": 22, "sections": 22, "paragraph_chunks": 33, "key_ideas": 33, "processing_progress": 22}
    assert all(f == at.folders[t].get(x) for t, of in before.folders.items() for x, f in of.items() if x != b) and at.folders["books"] == before.folders["books"]
    assert all(store.lookup(t, book_id=5).count() == 0 for t in ("chapters", "sections", "paragraph_chunks", "key_ideas"))
    chapter = store.lookup("chapters", book_id=6, chapter_number=2).first().id
    assert store.delete("sections", chapter_id=chapter) == 2 and counts(store)["paragraph_chunks"] == 33  # children stay without cascade
    assert store.delete("sections", cascade=True, chapter_id=chapter) == 0
    assert store.table("chapters", before).count() == 24
    section = store.lookup("sections", book_id=7, section_number=1).first().id
    assert store.delete("sections", cascade=True, id=section) == 1 and counts(store)["key_ideas"] == 32


def test_folders_are_put_together(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), 2)
    for i in range(6):
        store.append("books", spark.createDataFrame([(i, f"t{i}", "a", "p")], "id long, title string, author string, source_path string"))
    rows = sorted(map(tuple, store.table("books").collect()))
    store.compact("books", 1)
    assert all(len(x) == 1 for x in store.snapshot().folders["books"].values()) and sorted(map(tuple, store.table("books").collect())) == rows
    assert store.vacuum() >= 6 and sorted(map(tuple, store.table("books").collect())) == rows


# --- progress


class Counting:
    """A model that notes its calls in a file and fails for some texts."""

    def __init__(self, log, bad=None):
        self.log, self.bad = log, bad

    def __call__(self):
        def answer(text):
            with open(self.log, "a") as f:
                f.write(text[:14] + "\n")
            if self.bad and self.bad in text:
                raise RuntimeError("down")
            return json.dumps({"concept": text.split()[3]})

        return answer


def test_a_stopped_run_goes_on(spark, tmp_path, monkeypatch):
    path, log = str(tmp_path / "s"), str(tmp_path / "calls")
    config = DEFAULT.updated(retry_delays=(0,), retry_attempts=2)
    run = lambda bad=None: many_books(spark, 4, concept_model=Counting(log, bad), config=config)
    store, save, calls = Store(spark, path, 4), Store.save, []

    def stops(self, *a, **k):
        calls.append(1)
        if len(calls) == 4:  # after the first step's commit: pending, processing, done, then the second step
            raise KeyboardInterrupt
        return save(self, *a, **k)

    monkeypatch.setattr(Store, "save", stops)
    with pytest.raises(KeyboardInterrupt):
        run().resume(path, steps=2)
    monkeypatch.undo()
    asked = open(log).read().split("\n")[:-1]
    done = store.table("staged_ideas").count()
    assert 0 < done == len(asked) < 12 and counts(store)["books"] == 0
    state = run("book01 page 2").resume(path, steps=2)
    assert {(r.status, r.attempt_count) for r in state.collect()} == {("completed", 1), ("failed", 1)}
    assert sorted(r.id for r in store.table("books").collect()) == [0, 2, 3]  # the book of the failed chapter waits
    again = open(log).read().split("\n")[:-1]
    assert len(set(again)) == 12 and all(again.count(x) == 1 for x in set(again) if not x.startswith("book01 page"))
    state = run().resume(path)
    assert {(r.status, r.attempt_count) for r in state.collect()} == {("completed", 1), ("completed", 2)}
    assert counts(store) == {"books": 4, "chapters": 8, "sections": 8, "paragraph_chunks": 12, "key_ideas": 12, "processing_progress": 8}
    plain = str(tmp_path / "p")
    run().save(plain, buckets=4)
    cols = ["id", "book_id", "chapter_id", "section_id", "paragraph_index", "chapter_paragraph_index", "page_number", "body_text"]
    rows = lambda s: sorted(map(repr, s.table("paragraph_chunks").select(*cols).collect()))
    assert rows(store) == rows(Store(spark, plain))
    n = len(open(log).read())
    assert run().resume(path).count() == 8 and len(open(log).read()) == n  # nothing is left to ask


def test_failed_chapters_are_given_up(spark, tmp_path):
    path, config = str(tmp_path / "s"), DEFAULT.updated(retry_delays=(0,), retry_attempts=2)
    run = lambda: many_books(spark, 2, concept_model=Counting(str(tmp_path / "calls"), "book01 page 2"), config=config)
    store = Store(spark, path, 4)
    run().resume(path)
    assert sorted(r.id for r in store.table("books").collect()) == [0]
    state = {(r.book_id, r.status, r.attempt_count, r.error_message) for r in run().resume(path).collect()}
    assert (1, "failed", 2, "RuntimeError: down") in state and sorted(r.id for r in store.table("books").collect()) == [0, 1]
    assert counts(store)["paragraph_chunks"] == 5 and store.table("processing_progress").where("status = 'failed'").count() == 1


def test_two_writers_lose_no_attempt(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), 4)
    units = spark.createDataFrame([(1, 10, "processing"), (2, 20, "processing")], "book_id long, chapter_id long, status string")
    seen = progress.latest(store.table("progress_events"))
    for writer in ("a", "b"):  # both saw the empty state
        store.save({"progress_events": progress.events_of(units, seen, writer)})
    now = progress.latest(store.table("progress_events"))
    assert {(r.chapter_id, r.attempt_count, r.status) for r in now.collect()} == {(10, 2, "processing"), (20, 2, "processing")}
    ends = units.withColumn("status", F.when(F.col("chapter_id") == 10, "completed").otherwise("failed")).withColumn("error_message", F.lit("e"))
    store.save({"progress_events": progress.events_of(ends, now, "a")})
    last = {r.chapter_id: r for r in progress.latest(store.table("progress_events")).collect()}
    assert (last[10].status, last[20].status, last[20].error_message, last[10].last_seq) == ("completed", "failed", "e", 2) and last[10].completed_at


def test_a_stream_of_events(spark, tmp_path):
    store, source = Store(spark, str(tmp_path / "s"), 4), str(tmp_path / "events")
    columns = "id long, book_id long, chapter_id long, seq long, status string, error_message string, at timestamp, writer string, processing_unit string"
    at = lambda m: f"2024-01-01 00:{m:02d}:00"

    def send(rows):
        made = spark.createDataFrame([(i, b, c, q, s, None, at(q), "w", "chapter") for i, b, c, q, s in rows], columns.replace("at timestamp", "at string"))
        made.withColumn("at", F.col("at").cast("timestamp")).write.mode("append").parquet(source)

    def follow():
        query = track(spark.readStream.schema(columns).parquet(source), store, str(tmp_path / "check"))
        assert query.awaitTermination(120) and query.exception() is None

    send([(1, 1, 10, 1, "pending"), (2, 1, 10, 2, "processing"), (3, 2, 20, 3, "completed")])
    follow()
    state = lambda: {r.chapter_id: (r.status, r.attempt_count) for r in store.table("processing_progress").collect()}
    assert state() == {10: ("processing", 1), 20: ("completed", 0)} and store.snapshot().applied == {"progress": 0}
    send([(4, 1, 10, 3, "completed"), (5, 2, 20, 1, "processing"), (1, 1, 10, 1, "pending")])  # late, and one sent twice
    follow()
    assert state() == {10: ("completed", 1), 20: ("completed", 1)} and store.table("progress_events").count() == 5
    version = store.snapshot().version
    from tomeloom.streaming.track import apply

    apply(store, spark.read.parquet(source), ("progress", 1))  # a batch that is run again
    assert store.snapshot().version == version


def test_lookups_tell_the_place_in_the_outline(spark):
    chunks = queries.QUERIES["chunks_by_book"](spark, SF)
    assert chunks.columns == ["book_id", "page_number", "toc_idx", "paragraph_index", "body_text"]
    rows = [tuple(r) for r in chunks.collect()]
    kept = queries.book(spark, SF).kept.where("book_id = 5 and concept is not null").select("book_id", "page", "toc_idx", "book_paragraph_index", "paragraph")
    assert rows and sorted(rows) == sorted(tuple(r) for r in kept.collect()) and rows == sorted(rows, key=lambda r: (r[1], r[3]))
    ideas = queries.QUERIES["ideas_by_book"](spark, SF)
    kept = queries.book(spark, SF).kept.where("book_id = 5 and concept is not null").select("book_id", "toc_idx", "concept")
    assert ideas.columns == ["book_id", "toc_idx", "core_idea_text"] and sorted(map(tuple, ideas.collect())) == sorted(map(tuple, kept.collect()))
    sections = queries.QUERIES["sections_by_chapter"](spark, SF)
    rows = [tuple(r) for r in sections.collect()]
    assert sections.columns == ["book_id", "chapter_number", "section_number", "title"] and rows and {r[:2] for r in rows} == {(5, 1)} and [r[2] for r in rows] == list(range(1, len(rows) + 1))
