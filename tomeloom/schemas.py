"""Schemas of all stored tables and of model output."""

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ddl = {
    "books": "id BIGINT NOT NULL, title STRING NOT NULL, author STRING, source_path STRING, created_at TIMESTAMP",
    "chapters": "id BIGINT NOT NULL, book_id BIGINT NOT NULL, chapter_number INT, title STRING, start_page INT, end_page INT, level INT, parent_chapter_id BIGINT, detection_method STRING, created_at TIMESTAMP",
    "sections": "id BIGINT NOT NULL, chapter_id BIGINT NOT NULL, book_id BIGINT NOT NULL, section_number INT, title STRING NOT NULL, level INT, parent_section_id BIGINT, detection_method STRING, created_at TIMESTAMP",
    "paragraph_chunks": "id BIGINT NOT NULL, book_id BIGINT, page_number INT, paragraph_index INT, body_text STRING NOT NULL, created_at TIMESTAMP, chapter_id BIGINT, chapter_paragraph_index INT, section_id BIGINT, toc_idx INT",
    "idea_groups": "id BIGINT NOT NULL, canonical_idea_text STRING NOT NULL, created_at TIMESTAMP",
    "key_ideas": "id BIGINT NOT NULL, chunk_id BIGINT, book_id BIGINT, core_idea_text STRING NOT NULL, idea_group_id BIGINT, created_at TIMESTAMP",
    "progress_events": "id BIGINT NOT NULL, book_id BIGINT, chapter_id BIGINT, seq BIGINT, status STRING, error_message STRING, at TIMESTAMP, writer STRING, processing_unit STRING",
    "staged_ideas": "id BIGINT NOT NULL, book_id BIGINT, chapter_id BIGINT, chapter_number INT, chapter_idx INT, toc_idx INT, level INT, page INT, hierarchy_path STRING, section_paragraph_index INT, chapter_paragraph_index INT, paragraph STRING, method STRING, concept STRING, error STRING",
    "idea_vectors": "id BIGINT NOT NULL, book_id BIGINT, idea_group_id BIGINT, vector ARRAY<DOUBLE>, created_at TIMESTAMP",
    "processing_progress": "id BIGINT NOT NULL, book_id BIGINT, page_number INT, status STRING, error_message STRING, attempt_count INT, last_attempt_at TIMESTAMP, completed_at TIMESTAMP, created_at TIMESTAMP, updated_at TIMESTAMP, chapter_id BIGINT, processing_unit STRING",
}
TYPES = {"BIGINT": T.LongType, "INT": T.IntegerType, "STRING": T.StringType, "TIMESTAMP": T.TimestampType, "ARRAY<DOUBLE>": lambda: T.ArrayType(T.DoubleType())}


def schema(ddl: str) -> T.StructType:
    """A schema from a short list of columns, without a session."""
    fields = [x.strip().split(" ", 2) for x in ddl.split(",")]
    return T.StructType([T.StructField(f[0], TYPES[f[1]](), len(f) < 3) for f in fields])


TABLES: dict[str, T.StructType] = {k: schema(v) for k, v in _ddl.items()}
#: Columns that rows may lack when they are stored; they are null then.
OPTIONAL = {
    "books": ("author", "source_path"),
    "chapters": ("parent_chapter_id",),
    "paragraph_chunks": ("toc_idx",),
    "key_ideas": ("idea_group_id",),
    "processing_progress": ("page_number",),
    "idea_vectors": ("idea_group_id",),
}
#: Ids of what belongs to a book carry the book's bucket, a number under this, in their low bits.
ID_BUCKETS = 4096


def book_bucket(book_id: Column, buckets: int = ID_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(book_id.cast("long")), F.lit(buckets))


def key_id(book_id: Column | str, *parts: Column | str) -> Column:
    """The id of what a book's natural key names: a hash of all of it, with the book's bucket in the low bits."""
    book, *rest = ((F.col(c) if isinstance(c, str) else c).cast("long") for c in (book_id, *parts))
    return F.shiftleft(F.xxhash64(book, *rest), 12).bitwiseOR(book_bucket(book))


#: Engine input.
PAGES = schema("book_id BIGINT, page_num INT, text STRING")
TOC = schema("book_id BIGINT, toc_idx INT, level INT, title STRING, page INT")
BOOK_META = schema("book_id BIGINT, title STRING, author STRING, source_path STRING, total_pages INT, producer STRING, creator STRING")
#: Model output, parsed with from_json.
IDEA_JSON = "concept STRING"
SPLIT_JSON = "paragraphs ARRAY<STRUCT<text: STRING, start_marker: STRING>>"
CHUNK_JSON = "paragraphs ARRAY<STRUCT<text: STRING, concept: STRING, section_title: STRING>>"


def init_tables(spark: SparkSession, path: str) -> None:
    """Make an empty store of all tables at path, if there is none."""
    from .sources.snapshots import Store

    Store(spark, path)
