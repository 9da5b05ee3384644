"""Calls of models from tasks: several at once in each task, at a limited rate, with retries; and answers that are stored, so that nothing is asked twice."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, EngineConfig
from ..session import ship, stored


def with_retries(call: Callable[[str], str], config: EngineConfig = DEFAULT, wait=time.sleep) -> Callable[[str], str]:
    """call, tried again after each of the delays (the last one repeats); the last error is raised."""

    def tried(text: str) -> str:
        for i in range(config.retry_attempts):
            try:
                return call(text)
            except Exception:
                if i + 1 == config.retry_attempts:
                    raise
                wait(config.retry_delays[min(i, len(config.retry_delays) - 1)])

    return tried


def at_most(per_second: float | None, clock=time.monotonic, wait=time.sleep) -> Callable[[], None]:
    """A gate that lets through so many a second, evenly, whichever thread asks; None: all."""
    lock, free = threading.Lock(), [0.0]

    def gate() -> None:
        if per_second is None:
            return
        with lock:
            now = clock()
            mine = max(free[0], now)
            free[0] = mine + 1 / per_second
        if mine > now:
            wait(mine - now)

    return gate


def in_order(call: Callable[[str], str], texts: list[str | None], config: EngineConfig, pool: ThreadPoolExecutor, gate: Callable[[], None]) -> list[tuple[str | None, str | None]]:
    """(reply, error) of each text, in their order, config.model_calls of them in flight; null texts are not asked."""

    def one(text: str | None) -> tuple[str | None, str | None]:
        if text is None:
            return None, None
        try:
            return call(text), None
        except Exception as e:  # one row's failure stays that row's
            return None, f"{type(e).__name__}: {e}"

    def gated(text: str) -> str:
        gate()
        return call_once(text)

    call_once, call = call, with_retries(gated, config)
    return list(pool.map(one, texts))


def replies(rows: DataFrame, text: str, factory: Callable[[], Callable[[str], str]], config: EngineConfig = DEFAULT) -> DataFrame:
    """rows with reply and error: what a model says to the column text. The model is made once in each task and called by up to config.model_calls threads."""
    ship(rows.sparkSession)
    names = [f"_{i}" for i in range(len(rows.columns))]
    asked, kinds = names[rows.columns.index(text)], [f.dataType.simpleString() for f in rows.schema]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        call, gate = factory(), at_most(config.calls_per_second)
        with ThreadPoolExecutor(config.model_calls) as pool:
            for batch in batches:
                for at in range(0, batch.num_rows, 1000):
                    part = batch.slice(at, 1000)
                    said = in_order(call, part.column(asked).to_pylist(), config, pool, gate)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array([r for r, _ in said], pa.string()), pa.array([e for _, e in said], pa.string())], [*names, "reply", "error"])

    schema = ", ".join([*[f"{n} {k}" for n, k in zip(names, kinds, strict=True)], "reply string", "error string"])
    return rows.toDF(*names).mapInArrow(run, schema).toDF(*rows.columns, "reply", "error")


def request_key(text: Column, prompt: str, config: EngineConfig = DEFAULT) -> Column:
    """What a model's answer depends on, as a hash: its version, the prompt and the text."""
    return F.sha2(F.concat_ws("\u0000", F.lit(config.model_version), F.lit(prompt), text), 256)


def answers_at(spark, path: str) -> DataFrame:
    """request_key, reply: what is answered so far."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path):
        return spark.createDataFrame([], "request_key string, reply string")
    return spark.read.schema("request_key string, reply string").parquet(path)


def ask_once(rows: DataFrame, text: str, prompt: str, factory: Callable[[], Callable[[str], str]], answers: str, config: EngineConfig = DEFAULT) -> DataFrame:
    """replies(), from the table of answers at a path where they are there: only requests that have no answer yet are asked, each once whatever number of rows has it.

    Answers are appended; failures are not, so a later run asks them again. Two runs at once may ask the same; the answer of least hash counts.
    """
    spark = rows.sparkSession
    keyed = stored(rows.withColumn("request_key", F.when(F.col(text).isNotNull(), request_key(F.col(text), prompt, config))), "requests")
    known = answers_at(spark, answers)
    wanted = keyed.where("request_key is not null").groupBy("request_key").agg(F.any_value(text).alias("ask")).join(known.select("request_key").distinct(), "request_key", "left_anti")
    said = stored(replies(wanted, "ask", factory, config), "replies")
    said.where("error is null and reply is not null").select("request_key", "reply").write.mode("append").parquet(answers)
    found = answers_at(spark, answers).groupBy("request_key").agg(F.min_by("reply", F.xxhash64("reply")).alias("reply"))
    found = stored(found.join(said.where("error is not null").select("request_key", "error"), "request_key", "full"), "answers")
    return keyed.join(found, "request_key", "left").drop("request_key")
