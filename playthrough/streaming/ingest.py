"""Continuous ingest of event messages into the raw event table.

Each micro-batch is written into a folder of its own and committed (``sources/commits.py``): a batch that is replayed
after a failure is there once, readers see it as a whole, and small folders are merged as the table grows.

Ids are unique. Which ids have come before is kept in the query's state, a partition per hash range of ids, so
that a batch looks up its own ids only and reads nothing of what is stored, however much that is. Of repeated ids in
one batch the oldest event stays. What other streams have stored in the same table is not in this one's state and is
looked up in their folders, of which there are usually none.

With ``remember_days`` there is no state: a batch is compared with the ids that arrived in that many days, and an
id repeated later is stored again, and left to the cleaning job, which is always exact. Time is that of arrival: late
events are kept.

The state of very many ids belongs on disk: set ``STATE_STORE`` (RocksDB) for the session, as the command line does.
The number of its partitions is that of ``spark.sql.shuffle.partitions`` at the first start.
"""

from __future__ import annotations

import datetime
import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from playthrough.operators.cleaning import first_per_event_id, rules
from playthrough.schemas import EVENT_COLUMNS
from playthrough.sources.commits import CommittedTable, Folder
from playthrough.sources.messages import parse_messages

BROADCAST_IDS = 500_000  # ids of one micro-batch sent to every executor at most; more are joined by a shuffle
ROWS_PER_FILE = 1_000_000

LIVE = {"processingTime": "1 second"}
BACKLOG = {"availableNow": True}

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def stored_events(
    spark: SparkSession, table: str, since: datetime.date | None = None, until: datetime.date | None = None
) -> DataFrame | None:
    """What has been ingested so far, with ``arrival_day``; None if there is nothing.

    With days given only their folders are read, whatever else the table holds.
    """
    stored = CommittedTable(spark, table)
    folders = stored.folders()
    if since is not None:
        folders = tuple(f for f in folders if since <= _day(f) <= until)
    found = stored.read(folders)
    return None if found is None else found.select(*EVENT_COLUMNS, "arrival_day")


def _day(folder: Folder) -> datetime.date:
    return datetime.date.fromisoformat(folder.path.split("/")[0].removeprefix("arrival_day="))


def without_stored(events: DataFrame, stored: DataFrame, n_events: int) -> DataFrame:
    """Drop events whose id is stored.

    A small batch's ids are broadcast to the stored ids, which then need no shuffle; a large batch
    is joined by a shuffle.
    """
    ids = events.select("event_id")
    if n_events <= BROADCAST_IDS:
        known = stored.select("event_id").join(F.broadcast(ids), "event_id", "left_semi")
        return events.join(known, "event_id", "left_anti")
    return events.join(stored.select("event_id"), "event_id", "left_anti")


def sort_messages(messages: DataFrame, clean: bool = False) -> DataFrame:
    """Parsed messages with the ``problem`` of those to be quarantined.

    With ``clean`` the cleaning rules are applied as well, so that the table holds valid rows only.
    """
    parsed = parse_messages(messages)
    if not clean:
        return parsed
    failed = [F.when(~F.coalesce(valid, F.lit(False)), reason) for reason, valid in rules(parsed.schema)]
    return parsed.withColumn("problem", F.coalesce("problem", *failed))


def first_seen(parsed: DataFrame) -> DataFrame:
    """Of a stream of parsed messages, those with a problem, and one event per id of the batch that has it first.

    An aggregate by id that keeps the first batch's time and its oldest event, and the last batch's time: it
    gives the ids of the current batch only, and an id is new if both times are the same. The time is fixed with the
    batch, so a batch that is replayed finds the same ids new.
    """
    rest = [c for c in EVENT_COLUMNS if c != "event_id"]
    good = parsed.filter(F.col("problem").isNull()).withColumn("_batch", F.current_timestamp())
    first = F.min(F.struct("_batch", *rest)).alias("_first")
    by_id = good.groupBy("event_id").agg(first, F.max("_batch").alias("_last")).filter(F.col("_first._batch") == F.col("_last"))
    none = F.lit(None).cast("string")
    new = by_id.select("event_id", *[F.col(f"_first.{c}").alias(c) for c in rest], none.alias("value"), none.alias("problem"))
    bad = parsed.filter(F.col("problem").isNotNull())
    return new.select(*EVENT_COLUMNS, "value", "problem").unionByName(bad.select(*EVENT_COLUMNS, "value", "problem"))


def _files(n: int) -> int:
    return -(-n // ROWS_PER_FILE)


def write_batch(
    parsed: DataFrame,
    batch_id: int,
    table: str,
    quarantine: str,
    remember_days: int | None = None,
    today: datetime.date | None = None,
    stream: str = "",
) -> None:
    """Split one micro-batch into new events and quarantined messages.

    Without ``remember_days`` the ids are taken to be new to the stream's own folders (see ``first_seen``).
    """
    spark = parsed.sparkSession
    today = today or datetime.datetime.now(datetime.timezone.utc).date()
    events_table, bad_table = CommittedTable(spark, table), CommittedTable(spark, quarantine)
    if events_table.has(stream, batch_id) and bad_table.has(stream, batch_id):
        return
    # Read by the count and both writes; lost blocks are recomputed from the source's offsets.
    batch = parsed.persist()
    try:
        counts = batch.agg(F.count(F.lit(1)).alias("n"), F.count("problem").alias("n_bad")).first()
        n, n_bad = counts["n"], counts["n_bad"]
        if n_bad:
            bad = batch.filter(F.col("problem").isNotNull()).select("value", "problem")
            # Adaptive execution, which would merge small files, is off in a stream.
            bad_table.append(bad.repartition(_files(n_bad)), f"batch_id={stream}{batch_id}", n_bad, stream, batch_id)
        if n == n_bad:
            return
        events = first_per_event_id(batch.filter(F.col("problem").isNull()))
        if remember_days is None:
            stored = events_table.read(tuple(f for f in events_table.folders() if f.stream != stream))
        else:
            stored = stored_events(spark, table, today - datetime.timedelta(days=remember_days), today)
        if stored is not None:
            events = without_stored(events, stored, n)
        # A shuffle, so that a join with stored ids keeps its own partitions.
        events = events.repartition(_files(n - n_bad))
        events_table.append(events, f"arrival_day={today}/batch_id={stream}{batch_id}", n - n_bad, stream, batch_id)
        events_table.merge()
        bad_table.merge()
    finally:
        batch.unpersist()


def ingest(
    messages: DataFrame,
    *,
    table: str,
    quarantine: str,
    checkpoint: str,
    trigger: dict = LIVE,
    clean: bool = False,
    remember_days: int | None = None,
    stream: str = "",
) -> StreamingQuery:
    """Start the query; ``trigger=BACKLOG`` takes what is there and stops.

    ``stream`` names this stream among those that write to the same table; a stream keeps its checkpoint.
    """
    parsed = sort_messages(messages, clean)
    write = functools.partial(write_batch, table=table, quarantine=quarantine, remember_days=remember_days, stream=stream)
    rows = first_seen(parsed) if remember_days is None else parsed
    return (
        rows.writeStream.foreachBatch(lambda batch, batch_id: write(batch, batch_id))
        .outputMode("update" if remember_days is None else "append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
