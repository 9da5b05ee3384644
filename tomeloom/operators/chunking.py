"""Sections to paragraphs: rule split, greedy merge, and a model's split with the rule split behind it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, EngineConfig
from ..functions.align import aligned_pieces
from ..functions.prefix import is_small, running
from ..functions.text import SPACES, marker_position, strip, truncate
from ..schemas import SPLIT_JSON, key_id
from ..session import stored
from .calls import replies

PIECE = "array<struct<text:string,start_char:int,end_char:int>>"
SLICE = 128


def rule_pieces(text: Column, config: EngineConfig = DEFAULT) -> Column:
    """Blocks between blank lines, stripped, those of min_paragraph characters or more with their place; none kept: the whole text. Null for a null text.

    One pass over each text in Arrow batches: offsets grow from block to block, and a fold over arrays would copy what it has at each block.
    """
    least = config.min_paragraph

    def of_slice(texts):
        import re

        found = []
        for t in texts:
            if t is None:
                found.append(None)
                continue
            at, kept = 0, []
            for block in re.split("\n\n+", t):
                x = block.strip(SPACES)
                if len(x) >= least:  # it is found at or after the end of the one before
                    start = t.index(x, at)
                    at = start + len(x)
                    kept.append((x, start, at))
            found.append(kept or [(t, 0, len(t))])
        return piece_lists(found)

    @F.arrow_udf(PIECE)
    def pieces(texts):
        from tomeloom.operators.chunking import by_slices

        return by_slices(of_slice, texts)

    return pieces(text)


def by_slices(convert: Callable, *columns):
    """One Arrow array of what convert makes of SLICE rows of the columns at a time, as lists: a batch may have 10,000 texts, and only a slice's are Python objects at once."""
    import pyarrow as pa

    return pa.concat_arrays([convert(*(c.slice(at, SLICE).to_pylist() for c in columns)) for at in range(0, max(1, len(columns[0])), SLICE)])


def piece_lists(found: list):
    """Lists of (text, start, end) as an Arrow array."""
    import pyarrow as pa

    kind = pa.struct([("text", pa.string()), ("start_char", pa.int32()), ("end_char", pa.int32())])
    flat = [x for row in found if row for x in row]
    parts = pa.StructArray.from_arrays([pa.array([x[i] for x in flat], f.type) for i, f in enumerate(kind)], fields=list(kind))
    ends = [0]
    for row in found:
        ends.append(ends[-1] + len(row or ()))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), parts, mask=pa.array([row is None for row in found], pa.bool_()))


def whole_piece(text: Column) -> Column:
    return F.array(F.struct(text.alias("text"), F.lit(0).alias("start_char"), F.length(text).alias("end_char"))).cast(PIECE)


def paragraphs_rule_split(rows: DataFrame, text: str = "content", config: EngineConfig = DEFAULT) -> DataFrame:
    """rows without text, with paragraph_index, paragraph, start_char and end_char in the text."""
    others = [c for c in rows.columns if c != text]
    found = rows.select(*others, F.posexplode(rule_pieces(F.col(text), config)).alias("paragraph_index", "piece"))
    return found.select(*others, "paragraph_index", F.col("piece.text").alias("paragraph"), F.col("piece.start_char").alias("para_start"), F.col("piece.end_char").alias("para_end"))


def split_paragraphs(rows: DataFrame, splitter: Callable[[str], str] | None = None, text: str = "content", config: EngineConfig = DEFAULT) -> DataFrame:
    """Paragraphs by a model: splitter gets the truncated text and returns JSON {"paragraphs": [{"text", "start_marker"}]}.

    A text of under min_section characters (stripped) is one paragraph; an empty one has none. No JSON, no paragraph or
    no splitter leads to the rule split of the whole text. method says which: whole, llm or rule; position_exact, whether the marker was found as it is.
    With config.align_pieces the model's pieces are aligned with the text: paragraphs are the text's own characters, without gap or overlap, also where the
    model changed white space or letters; a reply that is no copy of the text leads to the rule split too.
    The model is called once for each row, after the filters; store the result before using it twice.
    """
    others = [c for c in rows.columns if c != text]
    short = F.length(strip(F.col(text))) < config.min_section
    rows = rows.where(F.length(text) > 0)
    if splitter is None:
        rows = rows.withColumn("reply", F.lit(None).cast("string"))
    else:
        rows = rows.withColumn("ask", F.when(~short, truncate(F.col(text), config.truncate_at)))
        rows = replies(rows, "ask", lambda: splitter, config).drop("ask", "error")  # a failed call leads to the rule split
    said = F.from_json("reply", SPLIT_JSON)["paragraphs"]
    rows = rows.withColumn("said", F.filter(said, lambda p: F.length(p.text) > 0))
    body = F.col(text)

    def placed(p):
        at = marker_position(body, F.coalesce(p.start_marker, F.lit("")))
        return F.struct(p.text.alias("text"), at.alias("start_char"), (at + F.length(p.text)).cast("int").alias("end_char"))

    method = F.when(short, "whole").when(F.size("said") > 0, "llm").otherwise("rule")
    as_said = F.transform("said", placed).cast(PIECE)
    if config.align_pieces and splitter is not None:
        rows = stored(rows.withColumn("aligned", aligned_pieces(body, F.when(~short, F.transform("said", lambda p: p.text)), PIECE)), "aligned-pieces")  # stored: the model is called once
        method = F.when(short, "whole").when(F.size("aligned") > 0, "llm").otherwise("rule")
        as_said = F.col("aligned")
    rows = rows.withColumn("method", method)
    pieces = F.when(F.col("method") == "whole", whole_piece(body)).when(F.col("method") == "llm", as_said).otherwise(rule_pieces(F.when(F.col("method") == "rule", body), config))
    found = rows.select(*others, text, "method", F.posexplode(pieces).alias("paragraph_index", "piece"))
    exact = F.col("piece.text") == F.expr(f"substring(`{text}`, piece.start_char + 1, length(piece.text))")
    return found.select(*others, "method", "paragraph_index", F.col("piece.text").alias("paragraph"), F.col("piece.start_char").alias("para_start"), F.col("piece.end_char").alias("para_end"), exact.alias("position_exact"))


def greedy_pieces(text: Column, config: EngineConfig = DEFAULT) -> Column:
    """Blocks merged until a buffer has merge_max characters; a rest of under merge_min is dropped. Offsets add up emitted lengths. Null for a null text."""
    low, high = config.merge_min, config.merge_max

    @F.arrow_udf(PIECE)
    def pieces(texts):
        found = []
        for t in texts.to_pylist():
            if t is None:
                found.append(None)
                continue
            out, buf, size, at = [], [], 0, 0
            for block in [*t.split("\n\n"), None]:
                x = "" if block is None else block.strip(SPACES)
                if x:
                    size += len(x) + (2 if buf else 0)
                    buf.append(x)
                if buf and (size >= high or block is None and size >= low):
                    out.append(("\n\n".join(buf), at, at + size))
                    buf, size, at = [], 0, at + size
            found.append(out)
        return piece_lists(found)

    return pieces(text)


def chunks_greedy_merge(rows: DataFrame, text: str = "content", config: EngineConfig = DEFAULT) -> DataFrame:
    """rows without text, with paragraph_index, chunk, para_start and para_end."""
    others = [c for c in rows.columns if c != text]
    found = rows.select(*others, F.posexplode(greedy_pieces(F.col(text), config)).alias("paragraph_index", "piece"))
    return found.select(*others, "paragraph_index", F.col("piece.text").alias("chunk"), F.col("piece.start_char").alias("para_start"), F.col("piece.end_char").alias("para_end"))


def eligible_sections(leaves: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """Leaves with content of min_section characters, stripped."""
    return leaves.where(F.length(strip(F.col("content"))) >= config.min_section)


def placed_by_sections(parts: DataFrame) -> DataFrame:
    """parts with each paragraph's index in its book and chapter: its section's place, of a running count over sections, and its own in the section."""
    parts = stored(parts, "paragraphs")
    sections = stored(parts.groupBy("book_id", "chapter_number", "toc_idx").agg(F.count("*").alias("n")), "section-sizes")
    sections = running(sections, ["book_id"], "toc_idx", {"in_book": ("sum_before", F.col("n"))})
    first = sections.groupBy("book_id", "chapter_number").agg(F.min("in_book").alias("first"))
    sections = sections.join(first, ["book_id", "chapter_number"]).select("book_id", "toc_idx", "in_book", (F.col("in_book") - F.col("first")).alias("in_chapter"))
    placed = parts.join(sections, ["book_id", "toc_idx"])
    index = {"book_paragraph_index": "in_book", "chapter_paragraph_index": "in_chapter"}
    return placed.withColumns({c: (F.col(at) + F.col("paragraph_index")).cast("int") for c, at in index.items()}).select(*parts.columns, *index)


def chunks_build(leaves: DataFrame, splitter=None, config: EngineConfig = DEFAULT) -> DataFrame:
    """Chunks of eligible leaves in document order, with the index in the section, chapter and book, and a stable chunk_id."""
    parts = split_paragraphs(eligible_sections(leaves, config), splitter, "content", config)
    if is_small(leaves):  # few sections: windows over their paragraphs
        order, book = ["chapter_number", "toc_idx", "paragraph_index"], Window.partitionBy("book_id")
        at = {"book_paragraph_index": book.orderBy(*order), "chapter_paragraph_index": Window.partitionBy("book_id", "chapter_number").orderBy("toc_idx", "paragraph_index")}
        placed = parts.withColumns({c: F.row_number().over(w) - 1 for c, w in at.items()})
    else:
        placed = placed_by_sections(parts)
    placed = placed.withColumnRenamed("paragraph_index", "section_paragraph_index")
    return placed.withColumn("chunk_id", key_id("book_id", "toc_idx", "section_paragraph_index"))


def chunk_quality(chunks: DataFrame, leaves: DataFrame, low: int = 100, high: int = 1200) -> DataFrame:
    """For each section: chunks, those out of the length band, share of its text that they cover, and overlaps."""
    by = Window.partitionBy("book_id", "toc_idx").orderBy("section_paragraph_index")
    size = F.length("paragraph")
    over = F.greatest(F.coalesce(F.lag("para_end").over(by) - F.col("para_start"), F.lit(0)), F.lit(0))
    each = chunks.withColumns({"size": size, "overlap": over}).groupBy("book_id", "toc_idx").agg(F.count("*").alias("n_chunks"), F.count_if(~F.col("size").between(low, high)).alias("n_off_band"), F.sum("size").alias("chunk_chars"), F.sum("overlap").alias("overlap_chars"))
    return each.join(leaves.select("book_id", "toc_idx", F.length("content").alias("section_chars")), ["book_id", "toc_idx"]).withColumn("coverage", F.round(F.col("chunk_chars") / F.col("section_chars"), 6))


def sentence_chunks(rows: DataFrame, text: str = "content", low: int = 150, high: int = 1000, sentences: int = 5) -> DataFrame:
    """Chunks of whole sentences: one ends at `sentences` of them, or before it would pass `high` characters; while it is under `low` it goes on.

    A sentence ends after . ! or ? and white space. Sentences of a chunk are joined by a space; a longer sentence stays whole.
    """
    others = [c for c in rows.columns if c != text]

    @F.arrow_udf("array<string>")
    def chunks(texts):
        import re

        import pyarrow as pa

        ends, found = re.compile(r"(?<=[.!?])[ \t\n\x0b\f\r]+"), []
        for t in texts.to_pylist():
            out, buf, size = [], [], 0
            for x in ends.split((t or "").strip(SPACES)):
                if not x:
                    continue
                if buf and size >= low and (len(buf) >= sentences or size + 1 + len(x) > high):
                    out.append(" ".join(buf))
                    buf, size = [], 0
                size += len(x) + (1 if buf else 0)
                buf.append(x)
            found.append(out + [" ".join(buf)] if buf else out)
        return pa.array(found, pa.list_(pa.string()))

    return rows.select(*others, F.posexplode(chunks(F.col(text))).alias("paragraph_index", "chunk"))
