"""Hierarchy against a recursive restatement, chunking against plain loops, models against stand-ins."""

import json
import random
import re

from pyspark.sql import functions as F

from tomeloom.config import DEFAULT
from tomeloom.operators import chunking as C
from tomeloom.operators import calls, concepts, dedup, hierarchy, progress, reports, store
from tomeloom.operators import pages as P
from tomeloom.plans.pipeline import Book

TOC = "book_id long, toc_idx int, level int, title string, page int"


def recursive(entries, pos, size):
    """(idx -> (start, end, parent, path, chapter)) of entries [(level, title)] by nested scans."""
    out = {}

    def walk(items, start, end, parent, path, chapter):
        i = 0
        while i < len(items):
            idx, level, title = items[i]
            j = next((k for k in range(i + 1, len(items)) if items[k][1] <= level), len(items))
            s = max(pos[idx], start)
            e = min(pos[items[j][0]] if j < len(items) else end, end)
            mine = [*path, title]
            path_of = ""
            for t in mine:
                path_of = f"{path_of} > {t}" if path_of else t
            out[idx] = (s, e, parent, path_of, chapter)
            walk(items[i + 1 : j], s, e, idx, mine, chapter)
            i = j

    tops = [i for i, (level, _) in enumerate(entries) if level == 1]
    for n, i in enumerate(tops, 1):
        j = tops[n] if n < len(tops) else len(entries)
        s, e = pos[i], pos[j] if j < len(entries) else size
        out[i] = (s, e, None, entries[i][1], n)
        walk([(k, *entries[k]) for k in range(i + 1, j)], s, e, i, [entries[i][1]], n)
    return out


def test_nested_spans_match_the_recursive_form(spark):
    rng, rows, want, pages = random.Random(1), [], {}, []
    for b in range(60):
        n, p = rng.randint(0, 12), rng.randint(1, 8)
        texts = [rng.choice(["", "word " * rng.randint(1, 9), "tail-"]) for _ in range(p)]
        pages += [(b, i, t) for i, t in enumerate(texts)]
        entries = [(rng.randint(1, 4), rng.choice(["", "A", "B", "C"])) for _ in range(n)]
        nums = [rng.choice([rng.randrange(p), rng.randrange(p), -2, p + 3]) for _ in range(n)]
        rows += [(b, i, lv, t, q) for i, ((lv, t), q) in enumerate(zip(entries, nums, strict=True))]
        want[b] = (entries, nums)
    pages = spark.createDataFrame(pages, "book_id long, page_num int, text string")
    tree = hierarchy.structure(spark.createDataFrame(rows, TOC), pages).cache()
    at = {(r.book_id, r.page_num): r for r in P.normalized_pages(pages).collect()}
    full = {r.book_id: r.full_text for r in P.book_text(pages).collect()}
    got = {(r.book_id, r.toc_idx): r for r in tree.collect()}
    seen, paths = 0, {}
    for b, (entries, nums) in want.items():
        last = max(p for x, p in at if x == b)
        pos = [at[b, q].start_char if (b, q) in at else at[b, last].end_char for q in nums]
        for i, (s, e, parent, path, chapter) in recursive(entries, pos, len(full[b])).items():
            r = got[b, i]
            assert (r.start_char, r.end_char, r.parent_idx, r.chapter_number) == (s, e, parent, chapter)
            assert r.is_leaf == (i + 1 == len(entries) or entries[i + 1][0] <= entries[i][0])
            seen += 1
            paths[b, i] = path
    assert seen == len(got) > 100
    leaves = hierarchy.with_content(hierarchy.leaf_sections(tree), pages).collect()
    for r in leaves:
        assert r.content == full[r.book_id][r.start_char : max(r.start_char, r.end_char)]
        assert r.hierarchy_path == paths[r.book_id, r.toc_idx]
    assert {(r.book_id, r.toc_idx) for r in leaves} == {k for k, r in got.items() if r.is_leaf}


def test_content_of_long_books_crosses_buckets(spark):
    texts = ["x" * 30_000, "y" * 10, "z" * 50_000]
    pages = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "book_id long, page_num int, text string")
    toc = spark.createDataFrame([(1, 0, 1, "A", 0), (1, 1, 1, "B", 2)], TOC)
    book = Book(pages, toc.withColumn("page", F.col("page") + 1), None)
    got = {r.toc_idx: r.content for r in book.leaves.collect()}
    assert got == {0: texts[0] + "\n\n" + texts[1] + "\n\n", 1: texts[2]}


def plain_rule(text):
    kept, at, out = [x.strip() for x in re.split("\n\n+", text)], 0, []
    for x in kept:
        if len(x) >= 50:
            s = text.find(x, at)
            out.append((x, s, s + len(x)))
            at = s + len(x)
    return out or [(text, 0, len(text))]


def plain_merge(text):
    out, buf, at = [], "", 0
    for x in (y.strip() for y in text.split("\n\n")):
        if x:
            buf = buf + "\n\n" + x if buf else x
            if len(buf) >= 1500:
                out.append((buf, at, at + len(buf)))
                at, buf = at + len(buf), ""
    return out + ([(buf, at, at + len(buf))] if len(buf) >= 100 else [])


def pieces(rng):
    return "".join(rng.choice(["a" * n for n in (1, 49, 50, 51, 99, 100, 700, 1500)] + ["\n\n", "\n\n\n", "\n\n\n\n", "\n", " ", "same paragraph of more than fifty characters, again and again"]) for _ in range(rng.randint(0, 14)))


def test_splits_match_plain_loops(spark):
    rng = random.Random(2)
    texts = ["", " ", *[pieces(rng) for _ in range(150)]]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, content string")
    rule, merge = {}, {}
    for r in C.paragraphs_rule_split(df).orderBy("paragraph_index").collect():
        rule.setdefault(r.i, []).append((r.paragraph, r.para_start, r.para_end))
    for r in C.chunks_greedy_merge(df).orderBy("paragraph_index").collect():
        merge.setdefault(r.i, []).append((r.chunk, r.para_start, r.para_end))
    for i, t in enumerate(texts):
        assert rule[i] == plain_rule(t)
        assert merge.get(i, []) == plain_merge(t)


def test_split_by_a_model_and_behind_it(spark):
    long = "First part of it, long enough. " * 4 + "Second part."
    df = spark.createDataFrame([(1, long), (2, "short"), (3, ""), (4, long + "no"), (5, long + "none"), (6, " " * 200)], "i int, content string")

    def model(t):
        if t.endswith("no"):
            return "not JSON"
        if t.endswith("none"):
            return '{"paragraphs":[]}'
        return json.dumps({"paragraphs": [{"text": t[:20], "start_marker": t[:10]}, {"text": "Second part.", "start_marker": "Second  part."}]})

    got = C.split_paragraphs(df, model).orderBy("i", "paragraph_index").collect()
    by = {}
    for r in got:
        by.setdefault(r.i, []).append(r)
    assert [r.method for r in by[1]] == ["llm", "llm"] and by[1][1].para_start == long.index("Second") and by[1][0].position_exact
    assert (by[2][0].method, by[2][0].paragraph) == ("whole", "short") and 3 not in by and by[6][0].method == "whole"
    assert by[4][0].method == by[5][0].method == "rule"


def test_concepts_by_a_model_with_failures(spark):
    calls = []

    def factory():
        def model(text):
            calls.append(1)
            if "boom" in text:
                raise RuntimeError("down")
            return "[]" if "odd" in text else json.dumps({"concept": text[:3]})

        return model

    pad = " and some more words to make it long enough for a concept"
    df = spark.createDataFrame([(1, "abc" + pad), (2, "boom" + pad), (3, "odd" + pad), (4, "tiny")], "i int, paragraph string")
    got = {r.i: r for r in concepts.concept_extract(df, factory, config=DEFAULT.updated(retry_delays=(0,))).collect()}
    assert got[1].concept == "abc" and got[1].error is None
    assert got[2].concept is None and "down" in got[2].error
    assert got[3].concept is None and got[3].error and got[4].concept is None and got[4].error is None


def test_retries_wait_and_give_up():
    waits, n = [], []

    def call(_):
        n.append(1)
        raise ValueError

    try:
        calls.with_retries(call, DEFAULT.updated(retry_attempts=5), waits.append)("x")
    except ValueError:
        pass
    assert len(n) == 5 and waits == [1, 2, 4, 4]


IDEAS = "book_id long, chapter_number int, toc_idx int, section_paragraph_index int, chunk_id long, concept string"


def test_keep_first_dedup(spark):
    rows = [(1, 1, 1, 0, 10, "A"), (1, 1, 2, 0, 11, "A"), (1, 2, 3, 0, 12, "a"), (2, 1, 1, 0, 13, "A"), (1, 2, 4, 0, 14, ""), (1, 2, 5, 0, 15, ""), (1, 2, 6, 0, 16, None), (1, 1, 0, 0, 17, "B"), (1, 3, 9, 1, 18, "B")]
    df = spark.createDataFrame(rows, IDEAS)
    assert {r.chunk_id for r in dedup.dedup_within_book(df).collect()} == {10, 12, 13, 14, 15, 16, 17}
    assert {r.chunk_id for r in dedup.duplicates_skipped(df).collect()} == {11, 18}
    assert {r.chunk_id for r in dedup.dedup_global(df).collect()} == {10, 12, 14, 15, 16, 17}
    again = dedup.dedup_within_book(dedup.dedup_within_book(df))
    assert again.count() == 7
    known = spark.createDataFrame([(2, "A"), (1, "")], "book_id long, core_idea_text string")
    assert {r.chunk_id for r in dedup.dedup_against_store(df, known).collect()} == {r[4] for r in rows} - {13}
    assert {r.chunk_id for r in dedup.dedup_against_store(df, known, per_book=False).collect()} == {12, 14, 15, 16, 17, 18}


def test_progress(spark):
    ev = [(1, 1, 1, "pending", None), (1, 1, 2, "processing", None), (1, 1, 3, "failed", "e3"), (1, 1, 4, "processing", None), (1, 1, 5, "completed", None), (1, 2, 6, "processing", None), (2, 1, 7, "pending", None)]
    state = progress.transition(spark.createDataFrame(ev, "book_id long, unit_id int, seq long, status string, error string"))
    got = {(r.book_id, r.unit_id): r for r in state.collect()}
    assert (got[1, 1].status, got[1, 1].attempt_count, got[1, 1].error_message, got[1, 1].completed_seq) == ("completed", 2, "e3", 5)
    stats = {r.book_id: r for r in progress.progress_stats(state).collect()}
    assert (stats[1].completed, stats[1].processing, stats[1].completion_rate) == (1, 1, 50.0)
    assert progress.reset_stuck(state).where("was_reset").count() == 1
    assert {r.book_id: r.processed for r in progress.book_processed(state).collect()} == {1: False, 2: False}


def test_reports_and_store(spark, tmp_path):
    lines = spark.createDataFrame([(1, i, x) for i, x in enumerate(["a", "| x | y |", "| x | y |", "b", "| 1 |", "| 2 |", "| 3 |", "c"])], "d int, n int, line string")
    assert [r.line for r in reports.table_run_filter(lines, "d", "n").orderBy("n").collect()] == ["a", "| x | y |", "| x | y |", "b", "c"]
    pages = spark.createDataFrame([(1, 0, "Intro text. " * 20), (1, 1, "Body Text here. " * 20)], "book_id long, page_num int, text string")
    toc = spark.createDataFrame([(1, 0, 1, " One ", 1), (1, 1, 2, "Two", 2)], TOC)
    meta = spark.createDataFrame([(1, None, "", "/x/my.pdf", 2)], "book_id long, title string, author string, source_path string, total_pages int")
    book = Book(pages, toc, meta)
    book.save(str(tmp_path))
    back = {n: spark.read.parquet(f"{tmp_path}/{n}").collect() for n in ("books", "chapters", "sections", "paragraph_chunks", "key_ideas")}
    assert [len(x) for x in back.values()] == [1, 1, 1, 1, 1]
    assert (back["books"][0].title, back["books"][0].author) == ("my", "Unknown") and back["key_ideas"][0].core_idea_text == "Body"
    assert back["key_ideas"][0].chunk_id == back["paragraph_chunks"][0].id
    tree = json.loads(reports.result_tree_json(book.ideas).first().result)
    assert tree["sections"][0]["paragraphs"][0]["concept"] == "Body"
    made = store.books_build(book.meta)
    assert store.new_books(made, made).count() == 0
    left, gone, kids = store.delete_where(store.chapters_build(book.tree), made.select(F.col("id").alias("book_id")), ["book_id"], {"sections": (store.sections_build(book.tree), ["book_id"])})
    assert (left.count(), gone.first().deleted, kids["sections"].count()) == (0, 1, 0)


def test_stream_of_pages(spark, tmp_path):
    from tomeloom.streaming.ingest import ingest, page_stream

    def ideas(batch):
        return batch.select("book_id", F.lit(1).alias("chapter_number"), F.col("page_num").alias("toc_idx"), F.lit(0).alias("section_paragraph_index"), F.col("page_num").cast("long").alias("chunk_id"), F.col("text").alias("concept"))

    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for n, rows in enumerate([[(1, 0, "A"), (1, 1, "A"), (2, 0, "A")], [(1, 2, "A"), (1, 3, "B")]]):
        spark.createDataFrame(rows, "book_id long, page_num int, text string").coalesce(1).write.mode("append").parquet(src)
        q = ingest(page_stream(spark, src), ideas, out, str(tmp_path / "cp"))
        q.awaitTermination(60)
        assert q.exception() is None, n
    assert sorted((r.book_id, r.core_idea_text) for r in spark.read.parquet(out).collect()) == [(1, "A"), (1, "B"), (2, "A")]


def test_resume_asks_only_what_is_open(spark):
    chunks = spark.createDataFrame([(1, "first text"), (2, "second text")], "chunk_id long, paragraph string")
    answers = chunks.where("chunk_id = 1").select(calls.request_key(F.col("paragraph"), concepts.IDEA_PROMPT).alias("request_key"))
    assert [r.chunk_id for r in concepts.not_answered(chunks, answers).collect()] == [2]
    assert concepts.not_answered(chunks, answers, config=DEFAULT.updated(model_version="other")).count() == 2
    times = spark.sql("SELECT 1 AS book_id, 'processing' AS status, timestamp '2024-01-01 10:00:00' AS last_attempt_at UNION ALL SELECT 2, 'processing', timestamp '2024-01-01 10:50:00'")
    assert [r.book_id for r in progress.stuck(times, F.lit("2024-01-01 11:00:00").cast("timestamp")).collect()] == [1]


def test_json_logs(capsys):
    from tomeloom.log import get_logger

    get_logger("t", as_json=True).info("begun é", extra={"data": {"book": 3}})
    row = json.loads(capsys.readouterr().out)
    assert (row["message"], row["book"], row["level"]) == ("begun é", 3, "INFO")
