"""A stream of progress events into the store: the log, and the state of each unit, in one commit for each batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.progress import latest
from ..schemas import TABLES
from ..session import stored
from ..sources.snapshots import Conflict, Store, bucket_column


def apply(store: Store, events: DataFrame, batch: tuple[str, int] | None = None) -> None:
    """Append events (the columns of progress_events) and bring processing_progress up to date with them, in one commit.

    Events whose id is stored already change nothing. The states of the buckets that events touch are worked out anew from their logs, so late and disordered events count as those in time.
    """
    events = stored(events.select(*[F.col(f.name).cast(f.dataType) for f in TABLES["progress_events"]]).dropDuplicates(["id"]), "events")
    while True:
        at = store.snapshot()
        if batch and at.applied.get(batch[0], -1) >= batch[1]:
            return
        touched = [r.b for r in events.select(bucket_column("progress_events", at.buckets).alias("b")).distinct().collect()]
        log = store.table("progress_events", at, touched)
        fresh = events.join(log.select("id"), "id", "left_anti")
        new = store.stage("progress_events", fresh, at.buckets)
        all_ = log.unionByName(fresh)
        state, old = store.rewrite("processing_progress", touched, lambda _, all_=all_: latest(all_), at)
        try:
            # the log that the state rests on must still be whole: its folders are replaced by themselves and the new ones
            seen = {b: at.folders.get("progress_events", {}).get(b, []) for b in touched}
            store.commit({"progress_events": {b: seen.get(b, []) + new.get(b, []) for b in {*seen, *new}}, "processing_progress": state}, {"progress_events": seen, "processing_progress": old}, batch=batch)
            return
        except Conflict:
            continue


def track(events: DataFrame, store: Store, checkpoint: str, name: str = "progress") -> StreamingQuery:
    """Follow a stream of events. A batch that is run again, after its commit, changes nothing: the store knows the number of the last one of this name."""

    def write(batch: DataFrame, number: int) -> None:
        apply(store, batch, (name, number))

    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
