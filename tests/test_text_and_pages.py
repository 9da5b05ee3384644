"""Text functions and pages against plain Python, on edge cases."""

import re

import pytest
from pyspark.sql import functions as F

from tomeloom.config import DEFAULT
from tomeloom.functions import text as T
from tomeloom.operators import pages as P

TEXTS = ["", " ", "\n\n a ", "　x y\t", "a\n\n\n\nb", "emoji 😀é end", "x" * 10_000, "y" * 10_001, "ab  cd\n\nef ab cd", "\x1ca\x1f", None]


def col(spark, texts, *exprs):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [tuple(r)[1:] for r in df.select("i", *exprs).orderBy("i").collect()]


def test_strip_collapse_truncate_preview(spark):
    got = col(spark, TEXTS, T.strip(F.col("t")), T.collapse(F.col("t")), T.truncate(F.col("t")), T.preview(F.col("t")))
    for t, r in zip(TEXTS, got, strict=True):
        if t is None:
            assert r == (None,) * 4
            continue
        cut = t[:8000] + "\n\n[... truncated ...]\n\n" + t[-2000:] if len(t) > 10_000 else t
        assert r == (t.strip(), re.sub("\n{3,}", "\n\n", t), cut, t[:200].replace("\n", " ") + ("..." if len(t) > 200 else ""))


def plain_marker(text, marker, full="", start=0):
    if not marker:
        return start
    rest = text[start:]
    if marker in rest:
        return start + rest.index(marker)
    flat, key = re.sub(r"\s+", " ", rest), re.sub(r"\s+", " ", marker.strip())
    if key in flat:
        return start + (int(flat.index(key) / len(flat) * len(rest)) if flat else 0)
    if full and full != text:
        return plain_marker(full, marker)
    return start


@pytest.mark.parametrize(("marker", "full", "start"), [("", "", 3), ("cd", "", 0), ("cd", "", 5), ("ab cd", "", 0), ("ab cd", "", 4), ("zz", "xx zz", 2), ("zz", "", 1), ("b\ncd", "", 0), ("  ", "", 0)])
def test_marker_position(spark, marker, full, start):
    texts = [t for t in TEXTS if t is not None]
    got = col(spark, texts, T.marker_position(F.col("t"), F.lit(marker), F.lit(full), start))
    assert [r[0] for r in got] == [plain_marker(t, marker, full, start) for t in texts]


def test_front_matter(spark):
    titles = ["Cover", "  COPYRIGHT 2020", "Uncovered", "About the sea", "Chapter 1", "Contents", "My contents"]
    assert [r[0] for r in col(spark, titles, T.is_front_matter(F.col("t")))] == [True, True, False, True, False, True, False]


def plain_normalize(texts):
    kept = []
    for t in texts:
        t = (t or "").strip()
        if not t:
            continue
        if kept and kept[-1].endswith("-"):
            kept[-1] = kept[-1][:-1]
        kept.append(re.sub("\n{3,}", "\n\n", t))
    return "\n\n".join(kept)


BOOKS = {1: ["a-", "b", "", "c-"], 2: ["-", "x"], 3: ["", " \n"], 4: ["one\n\n\n\ntwo ", None, "three"], 5: ["solo-"], 6: ["a-", " ", "b"]}


def page_rows(spark):
    return spark.createDataFrame([(b, i, t) for b, ts in BOOKS.items() for i, t in enumerate(ts)], "book_id long, page_num int, text string")


def test_normalized_text_and_aligned_offsets(spark):
    rows = page_rows(spark)
    got = {r.book_id: r.full_text for r in P.book_text(rows).collect()}
    assert got == {b: plain_normalize(ts) for b, ts in BOOKS.items()}
    for r in P.normalized_pages(rows).collect():
        assert got[r.book_id][r.start_char : r.end_char] == r.text + r.glue
    joined = {r.book_id: r.full_text for r in P.book_text(rows, config=DEFAULT.updated(dehyphenate_join=True)).collect()}
    assert joined[1] == "ab\n\nc-" and joined[6] == "ab"


def test_raw_offsets(spark):
    rows = page_rows(spark).where("text is not null")
    at = {}
    for r in P.page_positions(rows).orderBy("book_id", "page_num").collect():
        assert (r.start_char, r.end_char) == (at.get(r.book_id, 0), at.get(r.book_id, 0) + len(r.text) + 1)
        at[r.book_id] = r.end_char


def test_config():
    assert DEFAULT.updated(min_section=5).min_section == 5
    with pytest.raises(ValueError):
        DEFAULT.updated(nothing=1)
    with pytest.raises(ValueError):
        DEFAULT.updated(offset_mode="other")
