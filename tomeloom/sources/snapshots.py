"""Stored tables with snapshots: all tables of a save appear at once, or not at all.

A table's rows lie in Parquet folders <table>/<run>/bucket=<n>. A manifest, <path>/_commits/<version>.json, names the folders that are part of the
store at that version; readers read the folders of one manifest. A writer writes new folders first, which no manifest names yet, and then
the next manifest, by a rename that fails if there is one of that version: then another writer was first, and this one looks at the new
state and tries again. So a run that stops between tables leaves nothing that a reader sees, and vacuum() clears it away.

A row's bucket comes from its book's id, and ids of chapters, sections, chunks and ideas carry their book's bucket in their low bits (schemas.key_id), so a lookup by any of them reads one bucket's
folders; within them rows are sorted by book, with Bloom filters on id. Deletes and merges write the buckets that they change anew and leave all others alone.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ID_BUCKETS, OPTIONAL, TABLES, book_bucket

Folders = dict[str, dict[int, list[str]]]  # table, bucket: folders


#: What hangs on a table's rows: table, its column, the table whose ids the column holds; parents first.
CHILDREN = {
    "chapters": (("sections", "chapter_id", "chapters"), ("paragraph_chunks", "chapter_id", "chapters"), ("key_ideas", "chunk_id", "paragraph_chunks"), ("processing_progress", "chapter_id", "chapters")),
    "sections": (("paragraph_chunks", "section_id", "sections"), ("key_ideas", "chunk_id", "paragraph_chunks")),
    "paragraph_chunks": (("key_ideas", "chunk_id", "paragraph_chunks"),),
}


#: Bloom filters on id, as large as a file's ids ask for.
BLOOM = {"parquet.bloom.filter.enabled#id": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


class Conflict(Exception):
    """Another writer changed a bucket that this commit replaces."""


@dataclass(frozen=True)
class Snapshot:
    version: int
    buckets: int
    folders: Folders = field(default_factory=dict)
    applied: dict[str, int] = field(default_factory=dict)  # the last batch of each stream that writes here


def own_key(name: str) -> str:
    """The column whose value gives the row's bucket: the book's id."""
    return "id" if name in ("books", "idea_groups") else "book_id"


def bucket_column(name: str, buckets: int) -> Column:
    """The bucket of a table's rows. Groups of ideas belong to no book; their ids are those of ideas."""
    return (F.pmod("id", F.lit(buckets)) if name == "idea_groups" else book_bucket(F.col(own_key(name)), buckets)).cast("int")


class Store:
    """Tables of schemas.TABLES at a path that driver and executors share. buckets: a power of two, fixed when the store is made."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path = spark, path.rstrip("/")
        if buckets < 1 or ID_BUCKETS % buckets:
            raise ValueError(f"buckets is a power of two up to {ID_BUCKETS}")
        if not self.versions():
            self._publish(Snapshot(0, buckets))

    # --- files

    def _at(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return fs, fs.makeQualified(p)

    def _names(self, path: str) -> list[str]:
        fs, p = self._at(path)
        return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self._names(f"{self.path}/_commits") if n.endswith(".json")]

    def _publish(self, new: Snapshot) -> bool:
        """Write a manifest; False if there is one of its version."""
        fs, made = self._at(f"{self.path}/_commits/{uuid.uuid4().hex}.tmp")
        out = fs.create(made, True)
        out.write(bytearray(json.dumps(new.__dict__).encode()))
        out.close()
        jvm, target = self.spark._jvm, self._at(f"{self.path}/_commits/{new.version:012d}.json")[1]
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.NONE
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration()).rename(made, target, how)
        except Py4JJavaError as e:
            fs.delete(made, False)
            if "FileAlreadyExists" in str(e.java_exception):
                return False
            raise
        return True

    # --- reading

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The newest state, or that of a version."""
        version = max(self.versions()) if version is None else version
        fs, p = self._at(f"{self.path}/_commits/{version:012d}.json")
        stream = fs.open(p)
        try:
            found = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        folders = {t: {int(b): x for b, x in of.items()} for t, of in found.pop("folders").items()}
        return Snapshot(folders=folders, **found)

    def table(self, name: str, at: Snapshot | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """A table as of a snapshot (the newest one by default), of all buckets or of some."""
        of = (at or self.snapshot()).folders.get(name, {})
        wanted = of if buckets is None else [b for b in buckets if b in of]
        paths = [f"{self.path}/{f}" for b in sorted(wanted) for f in of[b]]
        return self.spark.read.schema(TABLES[name]).parquet(*paths) if paths else self.spark.createDataFrame([], TABLES[name])

    def bucket_of(self, name: str, column: str, value: int, buckets: int) -> int | None:
        """The bucket of the rows whose column has a value; None where it doesn't tell."""
        if column == own_key(name) and name != "idea_groups" or column == "book_id":
            return self.spark.range(1).select(book_bucket(F.lit(value).cast("long"), buckets)).first()[0]
        return value % buckets if column == "id" or column in ("chapter_id", "section_id", "chunk_id", "parent_section_id") else None

    def lookup(self, name: str, order: list[str] | None = None, at: Snapshot | None = None, **equal) -> DataFrame:
        """Rows with the given values, in the given order with nulls last. Only the folders of one bucket are read if a value tells which."""
        at = at or self.snapshot()
        known = {b for c, v in equal.items() if v is not None and (b := self.bucket_of(name, c, v, at.buckets)) is not None}
        rows = self.table(name, at, () if len(known) > 1 else known or None)
        for c, v in equal.items():
            rows = rows.where(F.col(c) == v)
        return rows.orderBy(*[F.col(c).asc_nulls_last() for c in order]) if order else rows

    # --- writing

    def stage(self, name: str, rows: DataFrame, buckets: int | None = None) -> dict[int, list[str]]:
        """Write rows to new folders, which nobody sees before commit(); their names by bucket.

        Rows need the table's columns; only those of schemas.OPTIONAL may lack, and are null. created_at is now where it lacks.
        """
        buckets = buckets or self.snapshot().buckets
        if "created_at" in TABLES[name].names and "created_at" not in rows.columns:
            rows = rows.withColumn("created_at", F.current_timestamp())
        lacking = [f.name for f in TABLES[name] if f.name not in rows.columns and f.name not in OPTIONAL.get(name, ())]
        if lacking:
            raise ValueError(f"{name} needs {', '.join(lacking)}")
        cols = [(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in TABLES[name]]
        key = own_key(name)
        made = rows.select(*cols).withColumn("bucket", bucket_column(name, buckets)).hint("rebalance", "bucket")  # Spark splits a bucket of many rows
        order = list(dict.fromkeys(["bucket", key, *[c for c in ("chapter_number", "chapter_id", "section_number", "paragraph_index") if c in TABLES[name].names], "id"]))
        folder = f"{name}/{uuid.uuid4().hex}"
        made.sortWithinPartitions(*order).write.options(**BLOOM).partitionBy("bucket").parquet(f"{self.path}/{folder}")
        return {int(n.split("=")[1]): [f"{folder}/{n}"] for n in self._names(f"{self.path}/{folder}") if n.startswith("bucket=")}

    def commit(self, staged: Folders, replaced: Folders | None = None, check: Callable[[Snapshot], None] | None = None, batch: tuple[str, int] | None = None) -> Snapshot:
        """Make staged folders part of the store, in place of the replaced ones, in one step.

        check gets the state that the commit builds on, and raises what forbids it; it is asked again if another writer was first. A Conflict is raised if replaced folders aren't those of that state.
        batch: a stream's name and the number of its batch; one that is applied already changes nothing.
        """
        while True:
            now = self.snapshot()
            if batch and now.applied.get(batch[0], -1) >= batch[1]:
                return now
            if check:
                check(now)
            folders = {t: {b: list(x) for b, x in of.items()} for t, of in now.folders.items()}
            for t, of in (replaced or {}).items():
                for b, x in of.items():
                    if folders.get(t, {}).get(b, []) != x:
                        raise Conflict(f"{t}, bucket {b}")
                    folders.get(t, {}).pop(b, None)
            for t, of in staged.items():
                for b, x in of.items():
                    folders.setdefault(t, {}).setdefault(b, []).extend(x)
            new = Snapshot(now.version + 1, now.buckets, folders, now.applied | ({batch[0]: batch[1]} if batch else {}))
            if self._publish(new):
                return new

    def save(self, tables: dict[str, DataFrame], check: Callable[[Snapshot], None] | None = None, batch: tuple[str, int] | None = None) -> Snapshot:
        """Append rows to several tables in one commit."""
        buckets = self.snapshot().buckets
        return self.commit({name: self.stage(name, rows, buckets) for name, rows in tables.items()}, check=check, batch=batch)

    def append(self, name: str, rows: DataFrame) -> Snapshot:
        """Append the rows whose id the table lacks, so a rerun adds nothing."""
        fresh = rows.join(self.table(name).select("id"), "id", "left_anti")
        return self.save({name: fresh})

    def rewrite(self, name: str, touched: list[int], change: Callable[[DataFrame], DataFrame], at: Snapshot) -> tuple[dict[int, list[str]], dict[int, list[str]]]:
        """change() applied to the rows of some buckets: the staged folders and those that they replace."""
        old = {b: at.folders[name][b] for b in touched if b in at.folders.get(name, {})}
        new = self.stage(name, change(self.table(name, at, touched)), at.buckets)
        return new, old | {b: [] for b in new if b not in old}

    def delete(self, name: str, cascade: bool = False, **equal) -> int:
        """Delete the rows with the given values, and with cascade what hangs on them; the number of the table's own rows that went.

        Only the buckets that hold such rows are written anew. What hangs on a row lies in its bucket.
        """
        while True:
            at = self.snapshot()
            rows = self.lookup(name, at=at, **equal)
            counts = {r.bucket: r.n for r in rows.groupBy(bucket_column(name, at.buckets).alias("bucket")).agg(F.count("*").alias("n")).collect()}
            if not counts:
                return 0
            touched, gone = sorted(counts), {name: rows.select("id")}
            done = {name: self.rewrite(name, touched, lambda x: x.join(gone[name], "id", "left_anti"), at)}
            for child, column, parent in CHILDREN.get(name, ()) if cascade else ():
                lost = self.table(child, at, touched).join(gone[parent].withColumnRenamed("id", column), column, "left_semi")
                gone[child] = lost.select("id")
                if lost.head(1):
                    done[child] = self.rewrite(child, touched, lambda x, child=child: x.join(gone[child], "id", "left_anti"), at)
            try:
                self.commit({t: new for t, (new, _) in done.items()}, {t: old for t, (_, old) in done.items()})
                return sum(counts.values())
            except Conflict:
                continue  # another writer changed one of these buckets: look again

    def merge(self, name: str, fresh: DataFrame, into: Callable[[DataFrame, DataFrame], DataFrame], batch: tuple[str, int] | None = None) -> None:
        """Replace the buckets that fresh touches by into(their rows, fresh). fresh is read again where another writer was first: store it before."""
        while True:
            at = self.snapshot()
            if batch and at.applied.get(batch[0], -1) >= batch[1]:
                return
            touched = [r.b for r in fresh.select(bucket_column(name, at.buckets).alias("b")).distinct().collect()]
            new, old = self.rewrite(name, touched, lambda rows: into(rows, fresh), at)
            try:
                self.commit({name: new}, {name: old}, batch=batch)
                return
            except Conflict:
                continue

    def compact(self, name: str, most_folders: int = 8) -> None:
        """Write the buckets of more than so many folders anew, each as one folder."""
        at = self.snapshot()
        many = [b for b, x in at.folders.get(name, {}).items() if len(x) > most_folders]
        if many:
            new, old = self.rewrite(name, many, lambda rows: rows, at)
            self.commit({name: new}, {name: old})

    def vacuum(self, keep: int = 1) -> int:
        """Delete the folders that none of the newest `keep` versions names, and older manifests; the number of folders. Not while others write or read old versions: their folders aren't named yet, or no more."""
        kept = self.versions()[-keep:]
        live = {f for v in kept for of in self.snapshot(v).folders.values() for x in of.values() for f in x}
        gone = 0
        for name in TABLES:
            for run in self._names(f"{self.path}/{name}"):
                for bucket in self._names(f"{self.path}/{name}/{run}"):
                    if bucket.startswith("bucket=") and f"{name}/{run}/{bucket}" not in live:
                        fs, p = self._at(f"{self.path}/{name}/{run}/{bucket}")
                        gone += fs.delete(p, True)
        for v in self.versions()[:-keep]:
            fs, p = self._at(f"{self.path}/_commits/{v:012d}.json")
            fs.delete(p, False)
        return gone
