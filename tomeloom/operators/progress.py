"""Progress of chapters as an append-only event log; the state is the latest event of each unit.

The stored log is progress_events: an event's seq is one more than the largest of its unit that its writer saw, so a unit's events
are ordered by (seq, at, writer), and attempts are counted, never overwritten: two writers at once lose none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import percentage
from ..schemas import key_id

STATES = ("pending", "processing", "completed", "failed")
KEY = ["book_id", "unit_id"]


def progress_init(chapters: DataFrame, progress: DataFrame) -> DataFrame:
    """A pending row for each chapter of books that have no chapter rows yet."""
    begun = progress.where("processing_unit = 'chapter'").select("book_id").distinct()
    return chapters.join(begun, "book_id", "left_anti").select("book_id", F.col("chapter_number").alias("unit_id"), F.lit("pending").alias("status"), F.lit(0).alias("attempt_count"), F.lit("chapter").alias("processing_unit"))


def transition(events: DataFrame) -> DataFrame:
    """The state of each unit from its events (book_id, unit_id, seq, status, error): status is the last one's, attempts count the
    times of processing, and the last attempt, completion and error stay from when they were last set."""
    at = lambda s: F.max(F.when(F.col("status") == s, F.col("seq")))
    return events.groupBy(*KEY).agg(
        F.max_by("status", "seq").alias("status"), F.count_if(F.col("status") == "processing").alias("attempt_count"), at("processing").alias("last_attempt_seq"),
        at("completed").alias("completed_seq"), F.max_by(F.when(F.col("status") == "failed", F.col("error")), F.when(F.col("status") == "failed", F.col("seq"))).alias("error_message"),
    )


def pending(chapters: DataFrame, state: DataFrame) -> DataFrame:
    """Chapters whose state is pending, in order."""
    waiting = state.where("status = 'pending'").withColumnRenamed("unit_id", "chapter_number")
    return chapters.join(waiting, ["book_id", "chapter_number"], "left_semi").orderBy("book_id", "chapter_number")


def progress_stats(state: DataFrame) -> DataFrame:
    counts = [F.count_if(F.col("status") == s).alias(s) for s in STATES]
    return state.groupBy("book_id").agg(F.count("*").alias("total"), *counts).withColumn("completion_rate", percentage(F.col("completed"), F.col("total")))


def reset_stuck(state: DataFrame) -> DataFrame:
    """state with processing units pending again, and was_reset."""
    stuck = F.col("status") == "processing"
    return state.select(*[c for c in state.columns if c != "status"], F.when(stuck, "pending").otherwise(F.col("status")).alias("status"), stuck.alias("was_reset"))


def book_processed(state: DataFrame) -> DataFrame:
    each = state.groupBy("book_id").agg(F.count("*").alias("total"), F.count_if(F.col("status") == "completed").alias("completed"))
    return each.select("book_id", ((F.col("total") > 0) & (F.col("total") == F.col("completed"))).alias("processed"))


def remaining(rows: DataFrame, state: DataFrame) -> DataFrame:
    """rows (book_id, chapter_number ...) of chapters that aren't completed: where a stopped run goes on."""
    done = state.where("status = 'completed'").select("book_id", F.col("unit_id").alias("chapter_number"))
    return rows.join(done, ["book_id", "chapter_number"], "left_anti")


def stuck(state_times: DataFrame, now, minutes: int = 30) -> DataFrame:
    """Units in processing whose last attempt (last_attempt_at) is more than so many minutes before now."""
    return state_times.where((F.col("status") == "processing") & (F.col("last_attempt_at") < now - F.expr(f"INTERVAL {minutes} MINUTES")))


def latest(events: DataFrame) -> DataFrame:
    """The rows of processing_progress that stored events (schemas.TABLES, progress_events) amount to: one for each unit."""
    place, when = F.struct("seq", "at", "writer"), lambda s: F.when(F.col("status") == s, F.col("at"))
    failed = F.col("status") == "failed"
    found = events.groupBy("book_id", "chapter_id", "processing_unit").agg(
        F.max_by("status", place).alias("status"), F.max_by(F.when(failed, F.col("error_message")), F.when(failed, place)).alias("error_message"), F.count_if(F.col("status") == "processing").cast("int").alias("attempt_count"),
        F.max(when("processing")).alias("last_attempt_at"), F.max(when("completed")).alias("completed_at"), F.min("at").alias("created_at"), F.max("at").alias("updated_at"), F.max("seq").alias("last_seq"),
    )
    return found.withColumns({"id": key_id("book_id", "chapter_id", F.lit(1)), "page_number": F.lit(None).cast("int")})


def events_of(units: DataFrame, state: DataFrame, writer: str) -> DataFrame:
    """Events of units (book_id, chapter_id, status, and error_message where it failed): each one's seq follows the last one that state, of latest(), has for it."""
    last = state.select("book_id", "chapter_id", "last_seq")
    rows = units.join(last, ["book_id", "chapter_id"], "left").withColumn("seq", F.coalesce("last_seq", F.lit(0)) + 1)
    message = F.col("error_message") if "error_message" in units.columns else F.lit(None).cast("string")
    return rows.select(key_id("book_id", "chapter_id", "seq", F.xxhash64(F.lit(writer)), F.xxhash64("status")).alias("id"), "book_id", "chapter_id", "seq", "status", message.alias("error_message"), F.current_timestamp().alias("at"), F.lit(writer).alias("writer"), F.lit("chapter").alias("processing_unit"))
