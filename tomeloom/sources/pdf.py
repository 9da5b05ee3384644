"""Pages of PDF files as a Spark data source that opens files page by page.

A file is dealt into slices of its pages by its size, so a long book is read by many tasks. Filters on page_num and path reach the reader: it opens no other file and takes no
other page. Files are listed and opened through pyarrow's file systems; those on local or mounted paths are opened in place, others are read into memory whole.
"""

from __future__ import annotations

import importlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship

NAME = "tomeloom_pdf"
SCHEMA = T.StructType([T.StructField("path", T.StringType()), T.StructField("page_num", T.IntegerType()), T.StructField("text", T.StringType())])
BATCH = 50


@dataclass
class Slice(D.InputPartition):
    """The nth of `of` slices of a file's pages."""

    path: str
    nth: int
    of: int


def _at(uri: str):
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


class Reader(D.DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.library = options["path"], options.get("library", "fitz")
        self.slice_bytes = int(options.get("slicebytes", options.get("sliceBytes", 32 << 20)))
        self.low, self.high, self.paths = 0, None, None

    def pushFilters(self, filters: list[D.Filter]) -> Iterator[D.Filter]:
        for f in filters:
            column = getattr(f, "attribute", ())
            if column == ("page_num",) and isinstance(f, D.EqualTo | D.GreaterThan | D.GreaterThanOrEqual | D.LessThan | D.LessThanOrEqual):
                low = {D.EqualTo: f.value, D.GreaterThan: f.value + 1, D.GreaterThanOrEqual: f.value}.get(type(f), 0)
                high = {D.EqualTo: f.value + 1, D.LessThan: f.value, D.LessThanOrEqual: f.value + 1}.get(type(f))
                self.low = max(self.low, low)
                self.high = high if self.high is None or high is not None and high < self.high else self.high
            elif column == ("path",) and isinstance(f, D.EqualTo | D.In):
                paths = set(f.value) if isinstance(f, D.In) else {f.value}
                self.paths = paths if self.paths is None else self.paths & paths
            elif not isinstance(f, D.IsNotNull):
                yield f

    def partitions(self) -> list[Slice]:
        from pyarrow import fs

        system, top = _at(self.path)
        scheme = self.path[: self.path.index(top)] if top in self.path else ""
        info = system.get_file_info(top)
        found = [info] if info.is_file else system.get_file_info(fs.FileSelector(top, recursive=True))
        out = []
        for f in sorted(found, key=lambda f: f.path):
            path = scheme + f.path
            if f.is_file and f.path.lower().endswith(".pdf") and (self.paths is None or path in self.paths):
                few = self.high is not None and self.high - self.low <= BATCH
                n = 1 if few else max(1, -(-f.size // self.slice_bytes))
                out += [Slice(path, i, n) for i in range(n)]
        return out

    def read(self, part: Slice) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        if part is None:
            return
        system, path = _at(part.path)
        library = importlib.import_module(self.library)
        if isinstance(system, fs.LocalFileSystem):
            doc = library.open(path)
        else:
            with system.open_input_file(path) as f:
                doc = library.open(stream=f.read(), filetype="pdf")
        with doc:
            n = len(doc)
            first, last = max(self.low, n * part.nth // part.of), n * (part.nth + 1) // part.of
            last = last if self.high is None else min(last, self.high)
            for at in range(first, last, BATCH):
                nums = list(range(at, min(at + BATCH, last)))
                yield pa.RecordBatch.from_arrays([pa.array([part.path] * len(nums)), pa.array(nums, pa.int32()), pa.array([doc[i].get_text() for i in nums])], ["path", "page_num", "text"])


class Source(D.DataSource):
    """Options: path (a file or a folder), sliceBytes, library (a module with PyMuPDF's open())."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> Reader:
        return Reader(dict(self.options))


def pages(spark: SparkSession, path: str, **options) -> DataFrame:
    """book_id (a hash of the path), path, page_num, text of all pages of the PDF files at path."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Source)
    return spark.read.format(NAME).options(path=path, **options).load().select(F.xxhash64("path").alias("book_id"), "path", "page_num", "text")
