"""Where books come from: the engine's input contract, adapters for the test tables, samples, and PDF files whose outline is needed too (sources/pdf.py reads pages alone, sources/databases.py tables of a database).

Everything downstream takes pages(book_id, page_num, text), toc(book_id, toc_idx, level, title, page) and
book_meta(book_id, title, author, source_path, total_pages, producer, creator).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip
from ..schemas import PAGES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def conversation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation as a book, each turn as a page."""
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("book_id"), F.col("turn").cast("int").alias("page_num"), F.coalesce("text", F.lit("")).alias("text"))


def outline_of(pages: DataFrame) -> DataFrame:
    """A made-up raw outline (pages from 1) over pages: three levels in turn, titles from the text."""
    return pages.select("book_id", F.col("page_num").alias("toc_idx"), (1 + F.col("page_num") % 3).alias("level"), F.left("text", F.lit(20)).alias("title"), (F.col("page_num") + 1).alias("page"))


def conversation_meta(pages: DataFrame) -> DataFrame:
    """Metadata with gaps: every third book lacks a title, every second one an author."""
    meta = pages.groupBy("book_id").agg(F.count("*").cast("int").alias("total_pages"))
    title = F.when(F.col("book_id") % 3 != 0, F.concat(F.lit("Book "), F.col("book_id").cast("string")))
    author = F.when(F.col("book_id") % 2 != 0, F.concat(F.lit("Author "), F.col("book_id").cast("string")))
    return meta.select("book_id", title.alias("title"), author.alias("author"), F.format_string("/books/vol-%d.pdf", "book_id").alias("source_path"), "total_pages", F.when(F.col("book_id") % 5 != 0, "press").alias("producer"), F.lit("writer").alias("creator"))


def normalize_toc(raw: DataFrame) -> DataFrame:
    """Titles stripped, pages counted from 0."""
    return raw.select("book_id", "toc_idx", "level", strip(F.col("title")).alias("title"), (F.col("page") - 1).alias("page"))


def normalize_meta(raw: DataFrame) -> DataFrame:
    """Missing text fields are empty."""
    text = lambda c: F.coalesce(c, F.lit("")) if c in raw.columns else F.lit("")
    return raw.select("book_id", *[text(c).alias(c) for c in ("title", "author", "source_path")], "total_pages", *[text(c).alias(c) for c in ("producer", "creator")])


#: Own sample paragraphs.
SAMPLES = [
    "A cache keeps the results of earlier work close to where they are needed again.",
    "A shuffle moves rows between machines so that equal keys meet in one place.",
    "A watermark tells a stream how late an event may be and still count.",
    "A broadcast sends a small table to every worker and spares the large one a move.",
    "A checkpoint writes a table out so that its history need not be kept.",
    "A window looks at a row together with the rows around it.",
]


def samples(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(SAMPLES)), "idx int, text string")


def sample_at(spark: SparkSession, indices: DataFrame) -> DataFrame:
    """The sample of each index; indices wrap around."""
    wrapped = indices.withColumn("idx", F.pmod("index", F.lit(len(SAMPLES))).cast("int"))
    return wrapped.join(F.broadcast(samples(spark)), "idx").select("index", "text")


def _read_pdfs(spark: SparkSession, path: str, rows_of, schema: str) -> DataFrame:
    """path and what rows_of(document) yields as lists of rows, for each PDF file: read by the workers, which need PyMuPDF."""

    def read(batches):
        import fitz
        import pandas as pd

        names = [x.split()[0] for x in schema.split(", ")]
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                with fitz.open(stream=content, filetype="pdf") as doc:
                    for rows in rows_of(doc):
                        yield pd.DataFrame(rows, columns=names).assign(path=path)[["path", *names]]

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path).select("path", "content")
    return files.mapInPandas(read, f"path string, {schema}").withColumn("book_id", F.xxhash64("path"))


def pdf_pages(spark: SparkSession, path: str) -> DataFrame:
    """pages of PDF files; book_id is a hash of the path."""

    def pages(doc):
        for first in range(0, len(doc), 50):
            yield [(i, doc[i].get_text()) for i in range(first, min(first + 50, len(doc)))]

    return _read_pdfs(spark, path, pages, "page_num int, text string").select("book_id", "page_num", "text")


def pdf_outline(spark: SparkSession, path: str) -> DataFrame:
    """The raw outline of PDF files: pages from 1, titles as they are; normalize_toc() makes toc of it."""

    def entries(doc):
        yield [(i, level, title, page) for i, (level, title, page, *_) in enumerate(doc.get_toc())]

    return _read_pdfs(spark, path, entries, "toc_idx int, level int, title string, page int").select("book_id", "toc_idx", "level", "title", "page")


def pdf_meta(spark: SparkSession, path: str) -> DataFrame:
    """The metadata of PDF files, with gaps; normalize_meta() fills them."""

    def fields(doc):
        meta = doc.metadata or {}
        yield [(meta.get("title"), meta.get("author"), len(doc), meta.get("producer"), meta.get("creator"))]

    found = _read_pdfs(spark, path, fields, "title string, author string, total_pages int, producer string, creator string")
    return found.select("book_id", "title", "author", F.col("path").alias("source_path"), "total_pages", "producer", "creator")


def parquet_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGES).parquet(path)
