"""PDF files through a stand-in for the reader, saving twice, prompts, summaries, and texts, levels and vectors of odd size."""

import json
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tomeloom.config import DEFAULT
from tomeloom.functions.text import SPACE, strip
from tomeloom.operators import chunking, concepts, dedup, hierarchy, reports, store
from tomeloom.operators.pages import page_text
from tomeloom.plans.pipeline import Book

TOC = "book_id long, toc_idx int, level int, title string, page int"
READER = '''
import json

class Page:
    def __init__(self, text):
        self.text = text
    def get_text(self):
        return self.text

class Document:
    def __init__(self, data):
        self.data, self.metadata = data, data["meta"]
    def __enter__(self):
        return self
    def __exit__(self, *_):
        pass
    def __len__(self):
        return len(self.data["pages"])
    def __getitem__(self, i):
        return Page(self.data["pages"][i])
    def get_toc(self):
        return self.data["toc"]

def open(stream, filetype):
    return Document(json.loads(bytes(stream)))
'''
PAGES = ["One Intro words. " * 12, "Two Body words follow here. " * 12, "Three Deeper words. " * 12]


def files(tmp_path):
    data = {"pages": PAGES, "toc": [[1, " Part A ", 1], [2, "Sub", 2], [1, "Part B", 3]], "meta": {"title": "", "author": "Someone", "producer": "press", "creator": None}}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "my book.pdf").write_text(json.dumps(data))
    (tmp_path / "in" / "bare.pdf").write_text(json.dumps({"pages": ["no outline"], "toc": [], "meta": {}}))
    (tmp_path / "in" / "notes.txt").write_text("not a book")
    return str(tmp_path / "in")


def test_books_from_pdf_files(spark, tmp_path):
    (tmp_path / "fitz.py").write_text(READER)
    spark.sparkContext.addPyFile(str(tmp_path / "fitz.py"))
    book = Book.from_pdf(spark, files(tmp_path))
    meta = {r.source_path.split("/")[-1].replace("%20", " "): r for r in book.meta.collect()}
    mine = meta["my book.pdf"]
    assert (mine.title, mine.author, mine.producer, mine.creator, mine.total_pages) == ("", "Someone", "press", "", 3)
    assert meta["bare.pdf"].total_pages == 1 and set(meta) == {"my book.pdf", "bare.pdf"}
    assert [(r.toc_idx, r.level, r.title, r.page) for r in book.toc.orderBy("toc_idx").collect()] == [(0, 1, "Part A", 0), (1, 2, "Sub", 1), (2, 1, "Part B", 2)]
    assert [r.book_id for r in book.without_toc().collect()] == [meta["bare.pdf"].book_id]
    assert page_text(book.pages, mine.book_id, 2) == PAGES[2]
    for n in (3, -1):
        with pytest.raises(IndexError):
            page_text(book.pages, mine.book_id, n)
    chunks = store.chunks_persisted(book.kept).orderBy("paragraph_index").collect()
    assert [(r.page_number, r.toc_idx, r.section_id is None) for r in chunks] == [(1, 1, False), (2, 2, True)]


def plain_book(spark, **options):
    pages = spark.createDataFrame([(1, 0, PAGES[0]), (1, 1, PAGES[1]), (2, 0, PAGES[2])], "book_id long, page_num int, text string")
    toc = spark.createDataFrame([(1, 0, 1, "A", 1), (1, 1, 1, "B", 2), (2, 0, 1, "C", 1)], TOC)
    meta = spark.createDataFrame([(1, "First", None, "/x/1.pdf", 2), (2, "Second", None, "/x/2.pdf", 1)], "book_id long, title string, author string, source_path string, total_pages int")
    return Book(pages, toc, meta, **options)


def test_prompts_reach_the_model_and_failures_are_counted(spark):
    def chat():
        def answer(prompt, text):
            if "Three" in text:
                raise RuntimeError("down")
            if '"start_marker"' in prompt:
                half = len(text) // 2
                return json.dumps({"paragraphs": [{"text": t, "start_marker": t[:30]} for t in (text[:half], text[half:])]})
            return json.dumps({"concept": text.split()[0]})

        return answer

    def split(text):  # a splitter of one's own goes before the package's prompt
        return "no JSON"

    book = plain_book(spark, chat=chat, splitter=split, config=DEFAULT.updated(retry_delays=(0,), retry_attempts=1))
    got = {r.book_id: r for r in book.stats().collect()}
    assert (got[1].total_chapters, got[1].completed_chapters, got[1].failed_chapters, got[1].total_ideas) == (2, 2, 0, 2)
    assert (got[2].total_chapters, got[2].completed_chapters, got[2].failed_chapters, got[2].total_ideas) == (1, 0, 1, 0)
    lines = {r.book_id: r.summary.split("\n") for r in book.summary().collect()}
    assert lines[2] == ["method: toc", "chapters: 1", "sections: 1", "completed: 0", "failed: 1", "paragraphs: 1", "ideas: 0", "duplicates skipped: 0"]
    both = plain_book(spark, chat=lambda: lambda prompt, text: chat()(prompt, text.replace("Three", "3")))
    assert {r.method for r in both.chunks.collect()} == {"llm"} and {r.concept for r in both.ideas.collect()} >= {"One", "Two"}


def test_one_call_that_cuts_and_names(spark):
    def factory():
        def answer(prompt, text):
            assert '"section_title"' in prompt
            if text.startswith("bad"):
                return "no JSON"
            words = text.split()
            return json.dumps({"paragraphs": [{"text": w, "concept": w[0], "section_title": title} for w, title in zip(words, ["Top", None, "NULL"], strict=False)]})

        return answer

    rows = spark.createDataFrame([(1, "aa bb cc"), (2, "bad"), (3, ""), (4, None)], "id int, content string")
    got = concepts.split_and_name(rows, factory, config=DEFAULT.updated(merge_min=1)).orderBy("id", "paragraph_index").collect()
    assert [(r.id, r.paragraph_index, r.paragraph, r.concept, r.section_title) for r in got] == [(1, 0, "aa", "a", "Top"), (1, 1, "bb", "b", "Top"), (1, 2, "cc", "c", "Top"), (2, 0, "bad", None, None)]
    assert got[3].error and not got[0].error
    long = spark.createDataFrame([(1, "\n\n".join(["x" * 600] * 9))], "id int, content string")
    assert [len(r.chunk) for r in chunking.chunks_greedy_merge(long, config=DEFAULT.updated(merge_max=DEFAULT.big_chunk)).collect()] == [3008, 2406]


def test_equal_rows_are_named_apart(spark):
    def factory():
        return lambda prompt, text: json.dumps({"paragraphs": [{"text": w, "concept": w[0], "section_title": t} for w, t in zip(text.split(), [text.split()[0].title(), None], strict=False)]})

    rows = spark.createDataFrame([(1, "first one"), (1, "second two"), (1, "second two")], "id int, content string")
    got = sorted((r.paragraph_index, r.paragraph, r.section_title) for r in concepts.split_and_name(rows, factory, config=DEFAULT.updated(merge_min=1)).collect())
    assert got == [(0, "first", "First"), (0, "second", "Second"), (0, "second", "Second"), (1, "one", "First"), (1, "two", "Second"), (1, "two", "Second")]
    assert concepts.split_and_name(rows.select("content"), factory, config=DEFAULT.updated(merge_min=1)).where("paragraph_index = 1").count() == 3


def test_result_files(spark, tmp_path):
    reports.write_result_json(plain_book(spark).ideas, str(tmp_path / "json"))
    rows = spark.read.text(str(tmp_path / "json")).collect()
    assert {r.book_id for r in rows} == {1, 2} and sorted(json.loads(r.value)["title"] for r in rows) == ["A", "B", "C"]


def test_strip_is_white_space_of_unicode(spark):
    rows = [(c, f"{chr(c)}x {chr(c)}y{chr(c)}") for c in range(1, 0x3100)]
    df = spark.createDataFrame(rows, "c int, t string")
    want = F.regexp_replace("t", rf"(?U)^{SPACE}+|{SPACE}+\z", "")
    assert df.where(strip(F.col("t")) != want).count() == 0


def test_long_texts_are_cut_in_one_pass(spark):
    blocks = ["block %06d " % i + "x" * 45 for i in range(100_000)]
    df = spark.createDataFrame([(1, "\n\n".join(blocks))], "id int, content string")
    began = time.perf_counter()
    assert chunking.paragraphs_rule_split(df).agg(F.max("para_end")).first()[0] == len("\n\n".join(blocks))
    assert chunking.chunks_greedy_merge(df).agg(F.sum(F.length("chunk"))).first()[0] > 5_800_000
    assert chunking.sentence_chunks(df.select("id", F.replace("content", F.lit("\n\n"), F.lit(". ")).alias("content"))).count() > 5_000
    assert time.perf_counter() - began < 60


def test_cuts_match_folds_over_blocks(spark):
    rng = random.Random(7)
    texts = ["\n".join(rng.choice(["", "", " ", "aa bb.", "word " * rng.randint(1, 40), "　x　"]) for _ in range(rng.randint(0, 30))) for _ in range(120)] + ["", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, content string")
    got, pieces = {}, {}
    for r in chunking.chunks_greedy_merge(df).orderBy("id", "paragraph_index").collect():
        got.setdefault(r.id, []).append((r.chunk, r.para_start, r.para_end))
    for r in chunking.paragraphs_rule_split(df).orderBy("id", "paragraph_index").collect():
        pieces.setdefault(r.id, []).append((r.paragraph, r.para_start, r.para_end))
    for i, t in enumerate(texts[:-1]):
        out, buf, at = [], "", 0
        for x in t.split("\n\n"):
            if x.strip():
                buf = f"{buf}\n\n{x.strip()}" if buf else x.strip()
            if len(buf) >= DEFAULT.merge_max:
                out.append(buf)
                buf = ""
        out += [buf] if len(buf) >= DEFAULT.merge_min else []
        want = []
        for x in out:
            want.append((x, at, at + len(x)))
            at += len(x)
        assert got.get(i, []) == want
        kept = [x.strip() for x in re.split("\n\n+", t) if len(x.strip()) >= DEFAULT.min_paragraph]
        assert [p[0] for p in pieces[i]] == (kept or [t]) and all(t[a:b] == x for x, a, b in pieces[i])
    assert len(texts) - 1 not in got and len(texts) - 1 not in pieces


def test_levels_of_an_outline(spark):
    sizes = spark.createDataFrame([(1, 100)], "book_id long, size long")
    rows = lambda levels: spark.createDataFrame([(1, i, lv, f"t{i}", i, i * 10) for i, lv in enumerate(levels)], "book_id long, toc_idx int, level int, title string, page int, pos long")
    got = {r.toc_idx: r for r in hierarchy.nested(rows([1, 3, 1_000_000, 3, None, 1]), sizes).collect()}
    assert {i: r.parent_idx for i, r in got.items()} == {0: None, 1: 0, 2: 1, 3: 0, 5: None}
    assert {i: r.term for i, r in got.items()} == {0: 5, 1: 3, 2: 3, 3: 5, 5: None}
    many = range(1, hierarchy.MOST_LEVELS + 2)
    both = rows([0, 1]).union(rows([1, 2]).withColumn("book_id", F.lit(2))).union(rows(many).withColumn("book_id", F.lit(3))).union(rows([3, 1, 90]).withColumn("book_id", F.lit(4)))
    assert sorted({(r.book_id, r.toc_idx) for r in hierarchy.nested(both, sizes).collect()}) == [(2, 0), (2, 1), (4, 1), (4, 2)]
    assert {r.book_id: r.error for r in hierarchy.bad_outlines(both).collect()} == {1: "a level below 1", 3: "over 64 levels"}


def test_vectors_of_odd_shape(spark):
    rows = [(1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, [1.0]), (4, [3.0]), (5, [1.0, None]), (6, None), (None, [1.0, 2.0]), (7, [float("nan"), 1.0]), (8, [0.0, 0.0]), (9, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted((r.vec_a, r.vec_b) for r in dedup.near_dup_cosine(df, 0.9).collect()) == [(1, 2), (3, 4)]
    assert sorted((r.vec_a, r.vec_b) for r in dedup.near_dup_cosine(df, 0.9, block=2).collect()) == [(1, 2), (3, 4)]


def test_groups_of_long_chains(spark):
    pairs = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(90, 91)], "vec_a long, vec_b long")
    ideas = spark.createDataFrame([(i, f"idea {i}") for i in range(95)], "id long, core_idea_text string")
    got = {r.idea_group_id: r.members for r in dedup.idea_groups(pairs, ideas).collect()}
    assert (got[0], got[90], len(got)) == (41, 2, 95 - 40 - 1)


def test_scratch_tables_go(spark):
    from pathlib import Path

    from tomeloom.session import scratch, shared_dir, stored

    before = set(Path(shared_dir(spark).removeprefix("file://")).iterdir())
    with scratch(spark):
        df = stored(spark.range(5), "numbers")
        assert df.count() == 5
    with pytest.raises(Exception, match="numbers"), scratch(spark):
        df.count()
    left = set(Path(shared_dir(spark).removeprefix("file://")).iterdir()) - before
    assert not left and stored(spark.range(5), "numbers", 5).count() == 5
