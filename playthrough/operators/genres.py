"""Most frequent genre in a user's last 30 days; of equally frequent ones the smallest name.

Two ways give the same rows. With few genres, each has a sliding counter, a column of the frame that is windowed
anyway. With more, or an unknown number, the preference is followed through time: an event raises its genre's count
just after it and lowers it again when the 30 days are over. Only at these moments can a user's preference change, so
one walk over them in order of time, with the counts in a heap, finds all changes, and each event takes the latest
change before it. That work grows with the events, whatever the number of genres.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import chain, groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playthrough.functions.scalar import HISTORY_MS
from playthrough.operators.history import keyed_history
from playthrough.operators.keysplits import CHUNK, KeySplits, before_chunk
from playthrough.sources.checkpoint import stored
from playthrough.sources.code import ship_code

#: Genres that are counted in columns, at most.
MAX_COUNTERS = 24


def counters(genres: list[str]) -> dict[str, Column]:
    """One sliding counter per genre."""
    return {f"_genre{i}": F.when(F.col("genre") == g, 1).otherwise(0) for i, g in enumerate(sorted(genres))}


def most_frequent(genres: list[str]) -> Column:
    """The genre with the largest counter, null when all are zero."""
    counts = [F.col(f"_genre{i}") for i in range(len(genres))]
    if not counts:
        return F.lit(None).cast("string")
    top = F.greatest(*counts) if len(counts) > 1 else counts[0]
    return F.coalesce(*[F.when((c == top) & (c > 0), F.lit(g)) for c, g in zip(counts, sorted(genres))])


def genre_names(events: DataFrame) -> list[str] | None:
    """The genres of the enriched events, or None if there are too many for one counter column each.

    Of the events, not of the titles: a title may have got another genre, or be gone, since.
    """
    found = events.select("genre").dropna().distinct().limit(MAX_COUNTERS + 1).collect()
    return None if len(found) > MAX_COUNTERS else [r["genre"] for r in found]


def with_genre_preference(
    events: DataFrame, genres: list[str] | None, splits: KeySplits | None = None
) -> DataFrame:
    """``events`` (event_id, event_ts, user_id, genre, …) plus ``user_genre_preference``."""
    if genres is not None:
        found = keyed_history(events, ["user_id"], recent=counters(genres), span=HISTORY_MS, splits=splits)
        preference = most_frequent(genres).alias("user_genre_preference")
        return found.select(*events.columns, preference)
    return _from_changes(events, splits)


def _from_changes(events: DataFrame, splits: KeySplits | None) -> DataFrame:
    """Changes are rows among the events, in front of those of their moment; an event takes the last one before it."""
    events = stored(events)  # read twice below, once three columns of it
    changes = preference_changes(events, splits)
    marks = changes.select(
        F.lit("").alias("event_id"), F.col("at").alias("event_ts"), "user_id", F.struct("preferred").alias("_change")
    )
    rows = events.withColumn("_is_event", F.lit(True)).unionByName(marks, allowMissingColumns=True)
    found = keyed_history(rows, ["user_id"], lags={"_latest": F.col("_change")}, splits=splits)
    found = found.filter("_is_event")
    return found.select(*events.columns, F.col("_latest.preferred").alias("user_genre_preference"))


def preference_changes(events: DataFrame, splits: KeySplits | None = None) -> DataFrame:
    """user_id, at, preferred: the genre preferred from a moment on, null for none, at every moment it changes.

    Counts that change at the same moment are added up before they are sent. A hot user's moments are walked in chunks
    of time, each from the counts that the earlier ones leave.
    """
    ship_code(events.sparkSession)
    from_then, no_more = F.col("event_ts") + 1, F.col("event_ts") + HISTORY_MS + 1
    steps = F.array(F.struct(from_then.alias("at"), F.lit(1).alias("step")), F.struct(no_more.alias("at"), F.lit(-1).alias("step")))
    moments = events.filter(F.col("genre").isNotNull() & F.col("event_ts").isNotNull()).select("user_id", "genre", F.inline(steps))
    moments = moments.groupBy("user_id", "genre", "at").agg(F.sum("step").alias("step")).filter(F.col("step") != 0)
    if splits is None or not splits.any_hot:
        moments = moments.withColumn(CHUNK, F.lit(0))
    else:
        moments = stored(splits.assign(moments, F.col("at"), F.lit("")).select("user_id", CHUNK, "genre", "at", "step"))
        moments = moments.unionByName(_left_over(moments))
    # Not a call per group: with many users or chunks that would cost more than the walk.
    tasks = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    walked = moments.select("user_id", CHUNK, "at", "genre", "step").repartition(tasks, "user_id", CHUNK)
    return walked.sortWithinPartitions("user_id", CHUNK, "at").mapInArrow(_walk, CHANGES)


def _left_over(moments: DataFrame) -> DataFrame:
    """Counts at the start of each later chunk of a user, as steps at no moment."""
    chunks = moments.groupBy("user_id", CHUNK, "genre").agg(F.sum("step").alias("step"))
    of_user = moments.groupBy("user_id").agg(F.max(CHUNK).alias("_last")).filter(F.col("_last") > 0)
    up_to = before_chunk(["user_id", "genre"])
    running = chunks.join(of_user, "user_id").withColumn("_count", F.col("step") + F.coalesce(F.sum("step").over(up_to), F.lit(0)))
    following = F.lead(CHUNK).over(Window.partitionBy("user_id", "genre").orderBy(CHUNK))
    running = running.withColumn("_until", F.coalesce(following, F.col("_last"))).filter(
        (F.col("_count") > 0) & (F.col("_until") > F.col(CHUNK))
    )
    # The count holds from the next chunk to the one where it changes, that one's start included.
    later = F.explode(F.sequence(F.col(CHUNK) + 1, F.col("_until")))
    return running.select("user_id", later.alias(CHUNK), "genre", F.lit(None).cast("bigint").alias("at"), F.col("_count").alias("step"))


#: Changes that are handed over at once.
AT_ONCE = 10_000
CHANGES = "user_id string, at bigint, preferred string"


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The changes of each user, or of each chunk of a hot user; the rows come by user, chunk and moment, nulls first."""
    found: list[tuple[str, int, str | None]] = []
    rows = chain.from_iterable(zip(*(b[c].to_pylist() for c in ("user_id", CHUNK, "at", "genre", "step"))) for b in batches)
    for (user, _), chunk in groupby(rows, key=itemgetter(0, 1)):
        for at, preferred in _changes(chunk):
            found.append((user, at, preferred))
            if len(found) == AT_ONCE:
                yield _batch(found)
                found = []
    if found:
        yield _batch(found)


def _batch(found: list[tuple[str, int, str | None]]) -> pa.RecordBatch:
    kinds = {"user_id": pa.string(), "at": pa.int64(), "preferred": pa.string()}
    return pa.RecordBatch.from_pydict({c: pa.array(v, kinds[c]) for c, v in zip(kinds, zip(*found))})


def _changes(rows: Iterator[tuple]) -> Iterator[tuple[int, str | None]]:
    """Steps at no moment are the counts to start from."""
    counts: dict[str, int] = {}
    heap: list[tuple[int, str]] = []
    preferred = None
    for at, moment in groupby(rows, key=itemgetter(2)):
        for _, _, _, genre, by in moment:
            counts[genre] = counts.get(genre, 0) + by
            if counts[genre] > 0:
                heapq.heappush(heap, (-counts[genre], genre))
        # Entries of counts that have changed since are dropped when they come up.
        while heap and counts[heap[0][1]] != -heap[0][0]:
            heapq.heappop(heap)
        now = heap[0][1] if heap else None
        if now != preferred and at is not None:
            yield at, now
        preferred = now
