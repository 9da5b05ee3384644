"""Line dedup over content-defined chunks of lines, with DataFrame functions only.

Each line is hashed (28 bits of its md5). A chunk ends after a line where the rolling hash of it and the line
before meets a condition that one line in CUT does, so boundaries shift with the content: a passage has the
same inner boundaries wherever it stands. Chunks of at least two lines (and MIN_CHARS characters)
that occur in several places are removed but for the first one, by doc_id (nulls last), text key and place.

Hashes alone are aggregated over the corpus (map-side first, so a chunk that a third of all rows has is one row for
each task). Only chunks whose hash occurs again are fetched as text, compared byte by byte with the first
one of that hash and removed if equal. The two joins that carry whole texts are merge joins at every size: what they are
joined with grows with the corpus.

dedup_lines takes only whole chunks, as the SQL of op10_line_dedup does, so much of a repeated passage stays. dedup_runs does
the whole job: a line goes if it lies in a run of lines that stands at an earlier place too (without overlap), of at least two
lines and MIN_CHARS characters, or of one line of over LONG_LINE words. For that each line starts the shortest such run from it, and ends
the shortest one up to it; any repeated run is covered by such windows inside it. Of each removed line an earlier equal one
stays. A document of one line stays as it is: whole copies of it are near_dedup's.

Defined cases: a null text stays null with 0 lines; an empty text is one empty line; rows that agree in doc_id and
text are one document, each row with the same result; a text may become empty; other columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_key

CUT, PRIME, MIN_CHARS, LONG_LINE = 3, 65521, 40, 50


def chunked(docs: DataFrame, *keep) -> DataFrame:
    """keep, lines and an array `spans` of (first, last)."""
    rows = docs.where("text is not null").select(*keep, F.split("text", "\n", -1).alias("lines"), "text")
    rows = rows.withColumn("h", F.transform("lines", lambda x: F.conv(F.substring(F.md5(x.cast("binary")), 1, 7), 16, 10).cast("long")))
    n = F.size("lines")
    ends = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == n - 1) | ((i > 0) & ((F.get("h", i - 1) * 31 + F.get("h", i)) % PRIME % CUT == 0)))
    rows = rows.withColumn("ends", ends)
    spans = F.transform("ends", lambda e, j: F.struct(F.when(j == 0, 0).otherwise(F.get("ends", j - 1) + 1).alias("first"), e.alias("last")))
    return rows.select(*keep, "lines", spans.alias("spans"))


def chunk_text(first, last) -> Column:
    return F.array_join(F.slice("lines", first + 1, last - first + 1), "\n")


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, key, first, last: chunks to remove."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"), "text")
    several = F.filter("spans", lambda s: s["last"] > s["first"])
    texts = F.transform(several, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"), chunk_text(s["first"], s["last"]).alias("chunk")))
    hashed = F.transform(F.filter(texts, lambda s: F.length(s["chunk"]) >= MIN_CHARS), lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"), F.xxhash64(s["chunk"]).alias("h")))
    each = chunked(rows, "doc_id", "key").select("doc_id", "key", F.inline_outer(hashed)).where("h is not null")  # outer: a plain one makes Spark build the array twice
    each = stored(each, "line-chunks")
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("key").alias("key"), F.col("first").alias("first"))
    again = each.groupBy("h").agg(F.min(place).alias("one"), F.max(place).alias("other")).where("one <> other").select("h", "one")
    again = stored(again, "line-again")  # a join right above an aggregate can't be split where a key is skewed
    marked = stored(each.join(again, "h").withColumn("is_first", place == F.col("one")).select("doc_id", "key", "first", "last", "h", "is_first").distinct(), "line-repeats")

    wanted = marked.groupBy("doc_id", "key").agg(F.collect_list(F.struct("first", "last", "h", "is_first")).alias("wanted")).select(F.col("doc_id").alias("d"), F.col("key").alias("k"), "wanted")
    texts = rows.where("text is not null").select("doc_id", "key", "text").hint("merge").join(wanted, (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("d")))
    found = lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"), s["h"].alias("h"), s["is_first"].alias("is_first"), chunk_text(s["first"], s["last"]).cast("binary").alias("bytes"))
    texts = texts.select("doc_id", "key", F.split("text", "\n", -1).alias("lines"), "wanted")
    texts = stored(texts.select("doc_id", "key", F.inline_outer(F.transform("wanted", found))), "line-bytes")
    firsts = stored(texts.where("is_first").groupBy("h").agg(F.first("bytes").alias("first_bytes")), "line-firsts")
    return texts.where("not is_first").join(firsts, "h").where("bytes = first_bytes").select("doc_id", "key", "first", "last").distinct()


def windows(docs: DataFrame, *keep) -> DataFrame:
    """keep, first, last, h: the shortest runs of at least two lines and MIN_CHARS characters from and to each line, and long lines."""
    rows = docs.where("text is not null").select(*keep, F.split("text", "\n", -1).alias("lines"))
    rows = rows.select(*keep, "lines", F.transform("lines", lambda x: F.length(x)).alias("sizes"), F.transform("lines", lambda x: F.xxhash64(x)).alias("hashes"))
    n, size = F.size("lines"), lambda i: F.get("sizes", i)

    def reach(i, to):  # the nearest line towards `to` with which the run from i has MIN_CHARS
        step = lambda s, j: F.when(s["end"] >= 0, s).otherwise(F.struct((s["chars"] + 1 + size(j)).alias("chars"), F.when(s["chars"] + 1 + size(j) >= MIN_CHARS, j).otherwise(-1).alias("end")))
        one = F.when(to > i, i + 1).otherwise(i - 1)
        end = F.aggregate(F.sequence(one, to), F.struct(size(i).alias("chars"), F.lit(-1).alias("end")), step)["end"]
        return F.when(end >= 0, end)

    def ahead(i):
        return F.when(i + 1 < n, F.when(size(i) + 1 + size(i + 1) >= MIN_CHARS, i + 1).otherwise(reach(i, F.least(i + MIN_CHARS, n - 1))))

    def back(i):  # a pair that suffices is found ahead
        return F.when((i > 0) & (size(i - 1) + 1 + size(i) < MIN_CHARS), reach(i, F.greatest(i - MIN_CHARS, F.lit(0))))

    span = lambda first, last: F.struct(first.alias("first"), last.alias("last"))
    long_line = lambda x: (F.length(x) > 2 * LONG_LINE) & (F.regexp_count(x, F.lit(r"\S+")) > LONG_LINE)
    lines = F.sequence(F.lit(0), n - 1)
    spans = F.concat(F.transform(lines, lambda i: span(i, ahead(i))), F.transform(lines, lambda i: span(back(i), i)), F.transform("lines", lambda x, i: span(F.when(long_line(x), i), i)))
    rows = rows.withColumn("spans", F.filter(spans, lambda s: s["first"].isNotNull() & s["last"].isNotNull()))
    hashed = F.transform("spans", lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"), F.xxhash64(F.slice("hashes", s["first"] + 1, s["last"] - s["first"] + 1)).alias("h")))
    return rows.select(*keep, F.inline_outer(hashed)).where("h is not null")


def repeated_runs(docs: DataFrame) -> DataFrame:
    """doc_id, key, first, last: windows to remove; they overlap."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"), "text")
    each = stored(windows(rows, "doc_id", "key"), "line-windows")
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("key").alias("key"), F.col("first").alias("first"))
    again = stored(each.groupBy("h").agg(F.min(place).alias("one"), F.max(place).alias("other")).where("one <> other").select("h", "one"), "line-again")
    overlaps = F.col("doc_id").eqNullSafe(F.col("one.doc_id")) & (F.col("key") == F.col("one.key")) & (F.col("first") - F.col("one.first") <= F.col("last") - F.col("first"))
    marked = stored(each.join(again, "h").select("doc_id", "key", "first", "last", "h", overlaps.alias("stays")).distinct(), "line-repeats")

    wanted = marked.groupBy("doc_id", "key").agg(F.collect_list(F.struct("first", "last", "h")).alias("wanted")).select(F.col("doc_id").alias("d"), F.col("key").alias("k"), "wanted")
    texts = rows.where("text is not null").hint("merge").join(wanted, (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("d")))
    texts = texts.select(F.split("text", "\n", -1).alias("lines"), "wanted")
    texts = texts.select(F.inline_outer(F.transform("wanted", lambda s: F.struct(s["h"].alias("h"), chunk_text(s["first"], s["last"]).cast("binary").alias("bytes")))))
    differ = stored(texts.groupBy("h").agg(F.min("bytes").alias("one"), F.max("bytes").alias("other")).where("one <> other").select("h"), "line-differ")
    return marked.where("not stays").join(differ, "h", "left_anti").select("doc_id", "key", "first", "last")


def dedup_lines(docs: DataFrame, stats: bool = False) -> DataFrame:
    """docs with repeated chunks taken out of text; with stats, also n_lines, n_removed (lines) and n_chunks (removed)."""
    return without(docs, repeats(docs).groupBy("doc_id", "key").agg(F.collect_list(F.struct("first", "last")).alias("gone")), stats)


def dedup_runs(docs: DataFrame, stats: bool = False) -> DataFrame:
    """docs with all repeated runs of lines taken out of text; with stats, also n_lines, n_removed (lines) and n_chunks (runs removed)."""
    at = F.sort_array(F.array_distinct(F.flatten(F.collect_list(F.sequence("first", "last"))))).alias("at")
    found = repeated_runs(docs).groupBy("doc_id", "key").agg(at)
    firsts = F.filter("at", lambda x, i: (i == 0) | (F.get("at", i - 1) < x - 1))
    lasts = F.filter("at", lambda x, i: (i == F.size("at") - 1) | (F.get("at", i + 1) > x + 1))
    gone = F.transform(F.arrays_zip(firsts.alias("first"), lasts.alias("last")), lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))
    return without(docs, found.select("doc_id", "key", gone.alias("gone")), stats, least_lines=2)


def without(docs: DataFrame, spans: DataFrame, stats: bool, least_lines: int = 1) -> DataFrame:
    """docs without the lines in spans (doc_id, key, gone), which do not overlap; texts under least_lines lines stay."""
    names = docs.columns
    own = lambda k: f"__{k}_" + "_".join(sorted(names))  # noqa: E731  clashes with no column
    gone = spans.withColumnsRenamed({"doc_id": own("d"), "key": own("k"), "gone": own("gone")})
    rows = docs.select(*[F.col(f"`{c}`") for c in names], text_key(F.col("text")).alias(own("key")))
    rows = rows.hint("merge").join(gone, (F.col(own("key")) == F.col(own("k"))) & F.col("doc_id").cast("long").eqNullSafe(F.col(own("d"))), "left")
    sorted_ = F.array_sort(own("gone"))
    rows = rows.withColumn(own("lines"), F.split("text", "\n", -1))  # once for each text, not for each chunk that goes
    lines = F.col(own("lines"))
    rows = rows.withColumn(own("gone"), sorted_ if least_lines < 2 else F.when(F.size(lines) >= least_lines, sorted_))
    gone = F.col(own("gone"))

    def between(j):  # the lines that stay before the j-th removed chunk, and after the last
        first = F.when(j == 0, 0).otherwise(F.get(gone, j - 1)["last"] + 1)
        end = F.when(j == F.size(gone), F.size(lines)).otherwise(F.get(gone, j)["first"])
        return F.slice(lines, first + 1, end - first)

    left = F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), between)), "\n")
    text = F.when(gone.isNull(), F.col("text")).otherwise(left)
    more = []
    if stats:
        total = F.aggregate(gone, F.lit(0), lambda n, s: n + s["last"] - s["first"] + 1)
        counts = {"n_lines": F.size(lines), "n_removed": total, "n_chunks": F.size(gone)}
        more = [F.when(c.isNull() | (c < 0), 0).otherwise(c).cast("long").alias(k) for k, c in counts.items()]
    return rows.select(*[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in names], *more)
