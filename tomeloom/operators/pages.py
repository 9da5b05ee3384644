"""Pages: lookups, running offsets and the text of whole books."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, EngineConfig
from ..functions.prefix import NONE, is_small, running
from ..functions.text import collapse, strip
from ..session import stored


def page_lookup(pages: DataFrame, book_id: int, page_num: int) -> DataFrame:
    """One page, as a table; no row where the book lacks it."""
    found = pages.where((F.col("book_id") == book_id) & (F.col("page_num") == page_num))
    return found.select("book_id", "page_num", "text")


def page_text(pages: DataFrame, book_id: int, page_num: int) -> str:
    """The text of one page; an IndexError where the book lacks it."""
    found = page_lookup(pages, book_id, page_num).head(1)
    if not found:
        raise IndexError(f"book {book_id} has no page {page_num}")
    return found[0].text or ""


def page_count(pages: DataFrame) -> DataFrame:
    return pages.groupBy("book_id").agg(F.count("*").cast("int").alias("total_pages"))


def page_positions(pages: DataFrame) -> DataFrame:
    """Offsets in the raw text: each page is followed by one line feed."""
    found = running(pages.select("book_id", "page_num", "text"), ["book_id"], "page_num", {"start_char": ("sum_before", F.length("text") + 1)}, small=is_small(pages))
    return found.select("book_id", "page_num", "start_char", (F.col("start_char") + F.length("text") + 1).alias("end_char"), "text")


def normalized_pages(pages: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """book_id, page_num, text, glue, start_char, end_char on the normalized text, for all pages.

    Pages are stripped and their runs of line feeds collapsed; a blank page has no text. The hyphen that ends a page goes if
    another page with text follows. glue is what stands after the page. Blank pages start where the next text would.
    """
    flat = pages.select("book_id", "page_num", collapse(strip(F.coalesce("text", F.lit("")))).alias("text"))
    small, shown = is_small(pages), F.when(F.col("text") != "", F.coalesce(F.col("page_num").cast("long"), F.lit(NONE)))
    if small:
        flat = flat.withColumn("last_shown", F.max(shown).over(Window.partitionBy("book_id")))
    else:
        last = flat.groupBy(F.col("book_id").alias("b")).agg(F.max(shown).alias("last_shown"))
        flat = flat.join(stored(last, "last-pages"), F.col("book_id").eqNullSafe(F.col("b")))
    flat = flat.withColumn("more", F.coalesce(F.coalesce(F.col("page_num").cast("long"), F.lit(NONE)) < F.col("last_shown"), F.lit(False)))
    hyphen = F.col("more") & F.col("text").endswith("-")
    flat = flat.withColumn("hyphen", hyphen & (F.col("text") != ""))
    flat = flat.withColumn("text", F.when(F.col("hyphen"), F.expr("left(text, length(text) - 1)")).otherwise(F.col("text")))
    joined = F.when(F.col("hyphen"), F.lit("")).otherwise(F.lit("\n\n")) if config.dehyphenate_join else F.lit("\n\n")
    shown = (F.col("text") != "") | F.col("hyphen")
    flat = flat.select("book_id", "page_num", "text", F.when(F.col("more") & shown, joined).otherwise(F.lit("")).alias("glue"))
    size = F.length("text") + F.length("glue")
    found = running(flat, ["book_id"], "page_num", {"start_char": ("sum_before", size)}, small=small)
    return found.select("book_id", "page_num", "text", "glue", "start_char", (F.col("start_char") + size).alias("end_char"))


def book_text(pages: DataFrame, normalize: bool = True, config: EngineConfig = DEFAULT) -> DataFrame:
    """book_id, full_text: one string for each book. For books that fit a row; sections are cut from pages, not from this."""
    if normalize:
        parts = normalized_pages(pages, config).select("book_id", "page_num", F.concat("text", "glue").alias("part"))
        return parts.groupBy("book_id").agg(F.expr("listagg(part, '') WITHIN GROUP (ORDER BY page_num)").alias("full_text"))
    return pages.groupBy("book_id").agg(F.expr("listagg(text, '\n') WITHIN GROUP (ORDER BY page_num)").alias("full_text"))


def positions(pages: DataFrame, config: EngineConfig = DEFAULT) -> DataFrame:
    """book_id, page_num, start_char, end_char by which outline entries are placed."""
    made = page_positions(pages) if config.offset_mode == "reference" else normalized_pages(pages, config)
    return made.select("book_id", "page_num", "start_char", "end_char")
