"""Sessions, and getting this package to the executors."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_sent: set[str] = set()
_inside: list[str] = []
FILE_ROWS = 100_000


def local_session(cpus: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benches on one machine."""
    conf = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": memory,
        "spark.ui.showConsoleProgress": "false",
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("tomeloom")
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application: Spark's file server carries it."""
    sc = spark.sparkContext
    if sc.applicationId in _sent:
        return
    _sent.add(sc.applicationId)
    top = Path(__file__).resolve().parent
    made = tempfile.mkdtemp(prefix="tomeloom-")  # Spark serves the file from here as long as the application runs
    shutil.copytree(top, f"{made}/zip/{top.name}", ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(f"{made}/{top.name}", "zip", f"{made}/zip"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, set here only for local runs that lack it."""
    sc = spark.sparkContext
    ship(spark)
    where = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not where:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: name a folder that driver and executors share")
        where = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", where)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(where)
    return where


@contextmanager
def scratch(spark: SparkSession):
    """What is stored inside is deleted at the end: for work whose result has been written by then."""
    _inside.append(f"scratch-{uuid.uuid4().hex}/")
    try:
        yield
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{_inside.pop()}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str, most_rows: int | None = None) -> DataFrame:
    """df as written to a new table in the shared folder: lineage ends there, and a lost executor costs nothing.

    most_rows: a bound on the rows, if one is known. Small tables of narrow rows then come as few files, of some FILE_ROWS each.
    """
    path = f"{shared_dir(df.sparkSession)}/{_inside[-1] if _inside else ''}{name}-{uuid.uuid4().hex}"
    if most_rows is not None:
        df = df.coalesce(max(1, -(-most_rows // FILE_ROWS)))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
