"""Sessions of a user on a title.

A session starts with an event that follows no other within 30 minutes. The default rule gives
every other event the timestamp of the *preceding event* as its session start, so a long session
falls into fragments of neighbouring events; stored features depend on that, so it is kept.
``sessionize_gap`` is the rule that keeps a session whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playthrough.functions import scalar
from playthrough.operators import keysplits as ks
from playthrough.operators.history import keyed_history
from playthrough.sources.checkpoint import stored

USER_CONTENT = ("user_id", "content_id")
SESSION = (*USER_CONTENT, "session_start_ts")


def _with_prev_ts(enriched: DataFrame, splits: ks.KeySplits | None) -> DataFrame:
    found = keyed_history(enriched, USER_CONTENT, lags={"_prev": F.col("event_ts")}, splits=splits)
    return found.withColumn("prev_ts", F.coalesce("_prev", F.lit(0).cast("bigint"))).drop("_prev")


def opens_session() -> Column:
    """A previous timestamp of 0 counts as none."""
    gap = F.col("event_ts") - F.col("prev_ts")
    return (F.col("prev_ts") == 0) | (gap > scalar.SESSION_GAP_MS)


def session_starts(enriched: DataFrame, splits: ks.KeySplits | None = None) -> DataFrame:
    found = _with_prev_ts(enriched.select("event_id", "event_ts", *USER_CONTENT), splits)
    return found.select("event_id", "event_ts", *USER_CONTENT, "prev_ts")


def with_session_start(df: DataFrame) -> DataFrame:
    start = F.when(opens_session(), F.col("event_ts")).otherwise(F.col("prev_ts"))
    return df.withColumn("session_start_ts", start)


def session_identification(enriched: DataFrame, splits: ks.KeySplits | None = None) -> DataFrame:
    return with_session_start(_with_prev_ts(enriched, splits)).drop("prev_ts")


def sessionize_gap(enriched: DataFrame, splits: ks.KeySplits | None = None) -> DataFrame:
    """All events up to the next gap of more than 30 minutes share the first one's timestamp."""
    opened = _with_prev_ts(enriched, splits).withColumn("_opened", F.when(opens_session(), F.col("event_ts")))
    found = keyed_history(opened, USER_CONTENT, lags={"_running": F.col("_opened")}, splits=splits)
    start = F.coalesce("_opened", "_running")
    return found.withColumn("session_start_ts", start).drop("prev_ts", "_opened", "_running")


def _near_end() -> Column:
    return scalar.stopped_near_end(F.col("event_type"), F.col("playback_position"), F.col("runtime"))


def _completed() -> Column:
    return F.when(F.col("event_type") == "complete", 1).otherwise(0)


def content_completion(sessions: DataFrame) -> DataFrame:
    """One row per session. All aggregates combine on the map side."""
    return sessions.groupBy(*SESSION).agg(
        F.max("event_ts").alias("session_end_ts"),
        F.max(_completed()).alias("is_completed_event"),
        F.max(_near_end()).alias("stopped_near_end"),
        F.countDistinct("event_type").alias("num_unique_events"),
    )


FACTS = [
    "session_end_ts",
    "is_completed_event",
    "stopped_near_end",
    "num_unique_events",
    "session_last_id",
    "pauses_so_far",
    "pair_sessions",
]


def with_session_facts(sessions: DataFrame, splits: ks.KeySplits | None = None) -> DataFrame:
    """Every event with the facts of its own session, its pauses up to and including now, and the
    number of sessions of its user and title.

    ``session_last_id`` is the event that ends the session, one per session: summing over these
    events is summing over sessions, which saves a join against the session table.
    """
    hot = splits is not None and splits.any_hot
    rows = clustered = sessions
    if hot:
        rows = stored(splits.assign(sessions, F.col("event_ts"), F.col("event_id")).drop(ks.LAST_TS))
        clustered = splits.cluster(rows)
    part = Window.partitionBy(*SESSION, *([ks.CHUNK, ks.SUB] if hot else []))
    pause = F.when(F.col("event_type") == "pause", 1).otherwise(0)
    end = F.max(F.struct("event_ts", "event_id"))
    so_far = part.orderBy("event_ts").rangeBetween(Window.unboundedPreceding, 0)
    facts = {
        "pauses_so_far": F.sum(pause).over(so_far),
        "_end": end.over(part),
        "is_completed_event": F.max(_completed()).over(part),
        "stopped_near_end": F.max(_near_end()).over(part),
        "num_unique_events": F.size(F.collect_set("event_type").over(part)).cast("bigint"),
    }
    out = clustered.withColumns(facts)
    if hot:
        out = _with_split_sessions(out, rows, pause, end)
    out = out.withColumns(
        {"session_end_ts": F.col("_end")["event_ts"], "session_last_id": F.col("_end")["event_id"]}
    )
    pair = Window.partitionBy(*USER_CONTENT, *([ks.CHUNK, ks.SUB] if hot else []))
    out = out.withColumn("pair_sessions", F.sum(ends_session()).over(pair))
    if hot:
        # One row per chunk and sub-chunk of a hot pair: no hint, and the rows of a pair stay spread.
        hot_rows, chunk = rows.filter(ks.HOT), [*USER_CONTENT, ks.CHUNK, ks.SUB]
        counts = hot_rows.groupBy(*USER_CONTENT).agg(F.countDistinct("session_start_ts").alias("_counted"))
        counts = hot_rows.select(*chunk).distinct().join(counts, list(USER_CONTENT))
        out = out.join(counts, chunk, "left")
        out = out.withColumn("pair_sessions", F.coalesce("_counted", "pair_sessions"))
    return out.select(*sessions.columns, *FACTS)


def _with_split_sessions(out: DataFrame, rows: DataFrame, pause: Column, end: Column) -> DataFrame:
    """Replace the facts of sessions that lie in several chunks of a hot key.

    A session holds events at its start timestamp and at most one later event, the next one. What its rows in a
    chunk add up to is one row, and so are its facts for each chunk: the rows of a session stay spread.
    """
    hot_rows = rows.filter(ks.HOT)
    at_start = F.col("event_ts") == F.col("session_start_ts")
    part = [*SESSION, ks.CHUNK, ks.SUB]
    parts = hot_rows.groupBy(*part).agg(
        end.alias("p_end"),
        F.max(_completed()).alias("p_completed"),
        F.max(_near_end()).alias("p_near_end"),
        F.collect_set("event_type").alias("p_types"),
        F.sum(F.when(at_start, pause).otherwise(0)).alias("p_pauses_at_start"),
        F.sum(pause).alias("p_pauses"),
    )
    split = (
        parts.groupBy(*SESSION)
        .agg(
            F.collect_list(F.struct(ks.CHUNK, ks.SUB)).alias("s_parts"),
            F.max("p_end").alias("s_end"),
            F.max("p_completed").alias("s_is_completed_event"),
            F.max("p_near_end").alias("s_stopped_near_end"),
            F.size(F.array_distinct(F.flatten(F.collect_list("p_types")))).cast("bigint").alias("s_num_unique_events"),
            F.sum("p_pauses_at_start").alias("s_pauses_at_start"),
            F.sum("p_pauses").alias("s_pauses"),
        )
        .filter(F.size("s_parts") > 1)
        .select("*", F.inline("s_parts"))
        .drop("s_parts")
    )
    joined = out.join(split, part, "left")
    is_split = F.col("s_end").isNotNull()
    pauses = F.when(at_start, F.col("s_pauses_at_start")).otherwise(F.col("s_pauses"))
    replaced = {
        name: F.when(is_split, F.col(f"s_{name}")).otherwise(F.col(name))
        for name in ["is_completed_event", "stopped_near_end", "num_unique_events"]
    }
    replaced["_end"] = F.when(is_split, F.col("s_end")).otherwise(F.col("_end"))
    replaced["pauses_so_far"] = F.when(is_split, pauses).otherwise(F.col("pauses_so_far"))
    return joined.withColumns(replaced)


def ends_session() -> Column:
    return F.when(F.col("event_id") == F.col("session_last_id"), 1).otherwise(0)


def ends_completed_session() -> Column:
    done = (F.col("is_completed_event") == 1) | (F.col("stopped_near_end") == 1)
    return F.when((F.col("event_id") == F.col("session_last_id")) & done, 1).otherwise(0)
