"""Tables of a database as a Spark data source, over any DB-API driver that the workers have: sqlite3, or psycopg2 for PostgreSQL.

Reads are split by ranges of a key, each over a connection of its own, and filters go into the query. A write is one transaction: tasks fill a
staging table, the driver moves its rows into the table when all tasks are done, and drops it if they fail. So tasks that Spark runs again add nothing twice.
"""

from __future__ import annotations

import datetime
import importlib
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import types as T

from ..schemas import TABLES
from ..session import ship

NAME = "tomeloom_db"
SQL_TYPES = {T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.StringType: "TEXT", T.TimestampType: "TIMESTAMP", T.DoubleType: "DOUBLE PRECISION"}
#: Without DATABASE_URL, a file in the working directory.
LOCAL_FILE = "local_dev.db"


def database_url(url: str | None = None) -> str:
    """The given url, else DATABASE_URL, else a local SQLite file."""
    return url or os.environ.get("DATABASE_URL") or f"sqlite:///{os.path.join(os.getcwd(), LOCAL_FILE)}"


class Database:
    """Connections to the database of a url."""

    def __init__(self, url: str):
        self.url, self.kind = url, url.split(":", 1)[0]
        if self.kind not in ("sqlite", "postgresql"):
            raise ValueError(f"no driver for {self.kind}")

    def connect(self):
        if self.kind == "sqlite":
            return importlib.import_module("sqlite3").connect(self.url.removeprefix("sqlite:///"), timeout=60)
        return importlib.import_module("psycopg2").connect(self.url)

    def run(self, statement: str, values=(), many: bool = False) -> list[tuple]:
        """One transaction; question marks stand for values."""
        link = self.connect()
        try:
            cursor = link.cursor()
            mark = statement if self.kind == "sqlite" else statement.replace("?", "%s")
            (cursor.executemany if many else cursor.execute)(mark, values)
            rows = cursor.fetchall() if cursor.description else []
            link.commit()
            return rows
        finally:
            link.close()


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def condition(f: D.Filter) -> tuple[str, list] | None:
    """A filter as SQL with its values; None if Spark has to apply it."""
    simple = {D.EqualTo: "=", D.GreaterThan: ">", D.GreaterThanOrEqual: ">=", D.LessThan: "<", D.LessThanOrEqual: "<="}
    path = getattr(f, "attribute", ())
    if len(path) != 1:
        return None
    column = quoted(path[0])
    if isinstance(f, D.IsNull | D.IsNotNull):
        return f"{column} IS {'NOT ' * isinstance(f, D.IsNotNull)}NULL", []
    if isinstance(f, D.In) and f.value and all(isinstance(v, int | str) for v in f.value):
        return f"{column} IN ({', '.join('?' * len(f.value))})", list(f.value)
    if type(f) in simple and isinstance(f.value, int | str) and not isinstance(f.value, bool):
        return f"{column} {simple[type(f)]} ?", [f.value]
    return None


@dataclass
class Range(D.InputPartition):
    """Keys from low to high (not included; None: no bound), and null keys where `nulls`."""

    low: int | None
    high: int | None
    nulls: bool


class Reader(D.DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.url, self.table = schema, options["url"], options["table"]
        self.key, self.n = options.get("key", "id"), int(options.get("partitions", 8))
        self.where: list[tuple[str, list]] = []

    def pushFilters(self, filters: list[D.Filter]) -> Iterator[D.Filter]:
        for f in filters:
            found = condition(f)
            if found:
                self.where.append(found)
            else:
                yield f

    def query(self, what: str, more: list[tuple[str, list]]) -> tuple[str, list]:
        parts = [*self.where, *more]
        return f"SELECT {what} FROM {quoted(self.table)}" + (" WHERE " + " AND ".join(c for c, _ in parts) if parts else ""), [v for _, vs in parts for v in vs]

    def partitions(self) -> list[Range]:
        key = quoted(self.key)
        low, high = Database(self.url).run(*self.query(f"min({key}), max({key})", []))[0]
        n = 1 if low is None else max(1, min(self.n, high - low + 1))
        cuts = [None, *[low + (high - low + 1) * i // n for i in range(1, n)], None]
        return [Range(a, b, i == 0) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]

    def read(self, part: Range) -> Iterator[tuple]:
        key, more = quoted(self.key), []
        if part.low is not None:
            more.append((f"{key} >= ?", [part.low]))
        if part.high is not None:
            more.append((f"({key} < ?{f' OR {key} IS NULL' * part.nulls})", [part.high]))
        database = Database(self.url)
        link = database.connect()
        try:
            cursor = link.cursor()
            statement, values = self.query(", ".join(quoted(f.name) for f in self.schema), more)
            cursor.execute(statement if database.kind == "sqlite" else statement.replace("?", "%s"), values)
            times = [isinstance(f.dataType, T.TimestampType) for f in self.schema]
            while rows := cursor.fetchmany(10_000):
                for row in rows:
                    yield tuple(datetime.datetime.fromisoformat(v) if t and isinstance(v, str) else v for v, t in zip(row, times, strict=True))
        finally:
            link.close()


@dataclass
class Done(D.WriterCommitMessage):
    rows: int
    task: int
    attempt: int


class Writer(D.DataSourceWriter):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.url, self.table = schema, options["url"], options["table"]
        self.stage = f"stage_{uuid.uuid4().hex}"  # made by the tasks: Spark makes more writers than it uses
        self.make = f"CREATE TABLE IF NOT EXISTS {self.stage} ({columns_of(schema)}, task INTEGER, attempt INTEGER)"

    def write(self, rows: Iterator) -> Done:
        from pyspark import TaskContext

        task = TaskContext.get()
        own = (task.partitionId(), task.attemptNumber())
        names = ", ".join(quoted(f.name) for f in self.schema)
        into = f"INSERT INTO {self.stage} ({names}, task, attempt) VALUES ({', '.join('?' * (len(self.schema) + 2))})"
        n, held, database = 0, [], Database(self.url)
        database.run(self.make)
        for row in rows:
            held.append(tuple(v.isoformat(" ") if isinstance(v, datetime.datetime) else v for v in row) + own)
            if len(held) == 10_000:
                database.run(into, held, many=True)
                n, held = n + len(held), []
        if held:
            database.run(into, held, many=True)
        return Done(n + len(held), *own)

    def commit(self, messages: list) -> None:
        names = ", ".join(quoted(f.name) for f in self.schema)
        database = Database(self.url)
        done = [m for m in messages if m is not None and m.rows]
        link = database.connect()
        try:
            cursor = link.cursor()
            mark = "?" if database.kind == "sqlite" else "%s"
            for m in done:  # the rows of attempts that failed stay behind
                cursor.execute(f"INSERT INTO {quoted(self.table)} ({names}) SELECT {names} FROM {self.stage} WHERE task = {mark} AND attempt = {mark}", (m.task, m.attempt))
            cursor.execute(f"DROP TABLE IF EXISTS {self.stage}")
            link.commit()
        finally:
            link.close()

    def abort(self, messages: list) -> None:
        Database(self.url).run(f"DROP TABLE IF EXISTS {self.stage}")


class Source(D.DataSource):
    """Options: url, table; to read, key (a column of integers by whose ranges reads are split) and partitions."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> T.StructType:
        return TABLES[self.options["table"]]

    def reader(self, schema: T.StructType) -> Reader:
        return Reader(schema, dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> Writer:
        if overwrite:
            raise ValueError("rows are appended only")
        return Writer(schema, dict(self.options))


def columns_of(schema: T.StructType) -> str:
    return ", ".join(f"{quoted(f.name)} {SQL_TYPES[type(f.dataType)]}{'' if f.nullable else ' NOT NULL'}" for f in schema)


def create_tables(url: str | None = None) -> None:
    """Make the tables that the database lacks, with an index on id (tables with vectors have no counterpart there)."""
    database = Database(database_url(url))
    for name, schema in TABLES.items():
        if all(type(f.dataType) in SQL_TYPES for f in schema):
            database.run(f"CREATE TABLE IF NOT EXISTS {quoted(name)} ({columns_of(schema)}, PRIMARY KEY (id))")


def _session(spark: SparkSession) -> None:
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Source)


def read_table(spark: SparkSession, name: str, url: str | None = None, key: str = "id", partitions: int = 8, schema: T.StructType | None = None) -> DataFrame:
    """A table of a database, read in ranges of key; simple filters are applied there."""
    _session(spark)
    reader = spark.read.format(NAME).options(url=database_url(url), table=name, key=key, partitions=partitions)
    return (reader.schema(schema) if schema else reader).load()


def append_table(rows: DataFrame, name: str, url: str | None = None) -> None:
    """Append rows to a table of a database in one transaction; rows may lack columns that may be null."""
    _session(rows.sparkSession)
    rows.write.format(NAME).options(url=database_url(url), table=name).mode("append").save()
