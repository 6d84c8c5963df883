"""The point-in-time tables, one function each.

Each takes the enriched events and returns one row per event unless it says otherwise. All of them
are window frames over one key. ``splits`` are the hot keys to cut (see ``keysplits``); without
them every key is windowed whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playthrough.functions import scalar
from playthrough.operators import genres, sessions
from playthrough.operators.history import keyed_history
from playthrough.operators.keysplits import KeySplits

USER, CONTENT = ["user_id"], ["content_id"]


def one() -> Column:
    return F.lit(1)


def ratio() -> Column:
    return scalar.scaled_ratio(F.col("playback_position"), F.col("runtime"))


def only(condition: Column, value: Column) -> Column:
    return F.when(condition, value).otherwise(0)


def engagement_sums() -> dict[str, Column]:
    return {"_ratio_sum": ratio(), "_ratio_n": only(ratio().isNotNull(), one())}


def stop_sums() -> dict[str, Column]:
    stopped = F.col("event_type") == "stop"
    return {"_stop_sum": F.when(stopped, ratio()), "_stop_n": only(stopped & ratio().isNotNull(), one())}


def engagement() -> Column:
    return scalar.mean_of_scaled(F.col("_ratio_sum"), F.col("_ratio_n"))


def stop_ratio() -> Column:
    return scalar.mean_of_scaled(F.col("_stop_sum"), F.col("_stop_n"))


def session_sums(prefix: str) -> dict[str, Column]:
    return {
        f"_{prefix}_sessions": sessions.ends_session(),
        f"_{prefix}_done": sessions.ends_completed_session(),
    }


def completion_rate(prefix: str) -> Column:
    return scalar.rate(F.col(f"_{prefix}_done"), F.col(f"_{prefix}_sessions"))


def user_activity(enriched: DataFrame, splits: KeySplits | None = None) -> DataFrame:
    """Events of the user in the 30 days before; 0 when there are none."""
    found = keyed_history(
        enriched.select("event_id", "user_id", "event_ts"),
        USER,
        recent={"user_activity_level": one()},
        span=scalar.HISTORY_MS,
        splits=splits,
    )
    return found.withColumn("user_activity_level", F.col("user_activity_level").cast("bigint"))


def user_engagement(enriched: DataFrame, splits: KeySplits | None = None) -> DataFrame:
    """Mean playback ratio of the user's 30 days before; only events that have such history."""
    found = keyed_history(
        enriched.select("event_id", "user_id", "event_ts", "playback_position", "runtime"),
        USER,
        recent={"_n": one(), **engagement_sums()},
        span=scalar.HISTORY_MS,
        splits=splits,
    )
    return found.filter(F.col("_n") > 0).select(
        "event_id", "user_id", "event_ts", engagement().alias("user_content_engagement")
    )


def user_genre_preference(
    enriched: DataFrame, genre_list: list[str] | None, splits: KeySplits | None = None
) -> DataFrame:
    """Most frequent genre of the user's 30 days before; null without history."""
    events = enriched.select("event_id", "user_id", "event_ts", "genre")
    found = genres.with_genre_preference(events, genre_list, splits)
    return found.select("event_id", "user_id", "event_ts", "user_genre_preference")


def clustered_by(df: DataFrame, key: list[str], *splits: KeySplits | None) -> DataFrame:
    """Shuffle by ``key`` at once: that also serves the windows by (user, title), which come first.

    Not with hot keys, whose rows must be spread.
    """
    return df if any(s is not None and s.any_hot for s in splits) else df.repartition(*key)


_SESSION_INPUT = ["event_id", "event_ts", "user_id", "content_id", "event_type", "playback_position", "runtime"]


def _facts(enriched: DataFrame, user_content_splits: KeySplits | None) -> DataFrame:
    found = sessions.session_identification(enriched.select(*_SESSION_INPUT), user_content_splits)
    return sessions.with_session_facts(found, user_content_splits)


def user_completion_rate(
    enriched: DataFrame, splits: KeySplits | None = None, user_content_splits: KeySplits | None = None
) -> DataFrame:
    """Completed share of the user's sessions that ended before the event; 0 without any."""
    events = clustered_by(enriched, USER, splits, user_content_splits)
    facts = _facts(events, user_content_splits)
    found = keyed_history(facts, USER, prior=session_sums("user"), splits=splits)
    return found.select("event_id", "user_id", completion_rate("user").alias("user_completion_rate"))


def content_completion_rate(
    enriched: DataFrame, splits: KeySplits | None = None, user_content_splits: KeySplits | None = None
) -> DataFrame:
    """Completed share of the title's sessions that ended before the event; 0 without any."""
    events = clustered_by(enriched, CONTENT, splits, user_content_splits)
    facts = _facts(events, user_content_splits)
    found = keyed_history(facts, CONTENT, prior=session_sums("content"), splits=splits)
    return found.select("event_id", "content_id", completion_rate("content").alias("content_completion_rate"))


def avg_view_duration_ratio(enriched: DataFrame, splits: KeySplits | None = None) -> DataFrame:
    """Mean playback ratio of the title's earlier stops; null without any."""
    events = enriched.select("event_id", "content_id", "event_ts", "event_type", "playback_position", "runtime")
    found = keyed_history(events, CONTENT, prior=stop_sums(), splits=splits)
    return found.select("event_id", "content_id", stop_ratio().alias("average_viewing_duration_ratio"))


def has_played_before(enriched: DataFrame, splits: KeySplits | None = None) -> DataFrame:
    """1 if the user had an earlier event on the title, else 0."""
    events = enriched.select("event_id", "user_id", "content_id", "event_ts")
    found = keyed_history(events, sessions.USER_CONTENT, prior={"_earlier": one()}, splits=splits)
    seen = F.when(F.col("_earlier") > 0, 1).otherwise(0)
    return found.select("event_id", "user_id", "content_id", seen.alias("has_played_before"))


def number_of_pauses(enriched: DataFrame, user_content_splits: KeySplits | None = None) -> DataFrame:
    """Pauses of the session up to and including the event; only events with at least one."""
    found = _facts(enriched, user_content_splits).filter(F.col("pauses_so_far") > 0)
    return found.select(
        "event_id", "user_id", "content_id", F.col("pauses_so_far").cast("bigint").alias("number_of_pauses")
    )


def first_view() -> Column:
    """Marks the first event of a user on a title, given the latest earlier timestamp."""
    return F.when(F.col("_prev").isNull(), 1).otherwise(0)


def content_popularity(
    enriched: DataFrame, splits: KeySplits | None = None, user_content_splits: KeySplits | None = None
) -> DataFrame:
    """Distinct users with an earlier event on the title."""
    events = enriched.select("event_id", "user_id", "content_id", "event_ts")
    events = clustered_by(events, CONTENT, splits, user_content_splits)
    marked = keyed_history(
        events, sessions.USER_CONTENT, lags={"_prev": F.col("event_ts")}, splits=user_content_splits
    )
    found = keyed_history(marked, CONTENT, prior={"_viewers": first_view()}, splits=splits)
    return found.select("event_id", "content_id", F.col("_viewers").cast("bigint").alias("content_popularity"))


def user_genre_recency(enriched: DataFrame) -> DataFrame:
    """Latest event per user and genre."""
    return enriched.groupBy("user_id", "genre").agg(F.max("event_ts").alias("last_genre_event_ts"))


def user_last_session_end(completion: DataFrame) -> DataFrame:
    """Latest session end per user."""
    return completion.groupBy("user_id").agg(F.max("session_end_ts").alias("last_completion_ts"))
