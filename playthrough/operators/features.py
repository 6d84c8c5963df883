"""The feature table: one row per enriched event, 40 columns.

All history of an event is a column of one wide frame. The frame is windowed three times, by
(user, title), by user and by title, instead of joining one satellite table per feature. Without hot
users the first two share the shuffle by user.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playthrough.functions import scalar
from playthrough.operators import genres, sessions, tables
from playthrough.operators.history import keyed_history
from playthrough.operators.keysplits import CHUNK_ROWS, KeySplits, find_splits
from playthrough.schemas import FEATURE_COLUMNS
from playthrough.sources.checkpoint import stored


@dataclass(frozen=True)
class HotKeys:
    user: KeySplits
    content: KeySplits
    user_content: KeySplits


NO_HOT_KEYS = HotKeys(KeySplits(("user_id",)), KeySplits(("content_id",)), KeySplits(sessions.USER_CONTENT))


def find_hot_keys(
    events: DataFrame, chunk_rows: int = CHUNK_ROWS, n_rows: int | None = None
) -> HotKeys:
    """Hot users, titles and pairs of raw, cleaned or enriched events.

    Below ``chunk_rows`` events in all it is a count, or nothing if ``n_rows``, their number or more, is known.
    Above, the columns that are looked at are stored: making the events once costs less than once for each look.
    """
    n = events.count() if n_rows is None else n_rows
    if n <= chunk_rows:
        return NO_HOT_KEYS
    events = stored(events.select("user_id", "content_id", "event_ts", "event_id"))
    sizes = {"chunk_rows": chunk_rows, "n_rows": n}
    user = find_splits(events, ["user_id"], reach=scalar.HISTORY_MS, **sizes)
    content = find_splits(events, ["content_id"], **sizes)
    pair = NO_HOT_KEYS.user_content
    if user.any_hot and content.any_hot:
        # A hot pair needs a hot user and a hot title.
        both = events.join(user.table.select("user_id"), "user_id", "left_semi").join(
            content.table.select("content_id"), "content_id", "left_semi"
        )
        pair = find_splits(both, sessions.USER_CONTENT, **sizes)
    return HotKeys(user, content, pair)


def with_history(enriched: DataFrame, genre_list: list[str] | None, hot: HotKeys = NO_HOT_KEYS) -> DataFrame:
    """Enriched events with their session and everything known before them."""
    rows = keyed_history(
        tables.clustered_by(enriched, tables.USER, hot.user, hot.user_content),
        sessions.USER_CONTENT,
        prior={"_earlier": tables.one()},
        lags={"_prev": F.col("event_ts")},
        splits=hot.user_content,
    )
    rows = rows.withColumn("prev_ts", F.coalesce("_prev", F.lit(0).cast("bigint")))
    rows = sessions.with_session_facts(sessions.with_session_start(rows), hot.user_content)
    counters = {} if genre_list is None else genres.counters(genre_list)
    # Events without a release year are no rows of the feature table: what looks at its rows skips them.
    listed = F.col("release_year").isNotNull()
    duration = F.col("session_end_ts") - F.col("session_start_ts")
    by_user = keyed_history(
        rows,
        tables.USER,
        prior=tables.session_sums("user"),
        recent={"_recent": tables.one(), **tables.engagement_sums(), **counters},
        span=scalar.HISTORY_MS,
        lags={
            "_prev_user_ts": F.when(listed, F.col("event_ts")),
            "_prev_session_end": F.when(listed, F.col("session_end_ts")),
        },
        totals={"_duration_sum": tables.only(listed, duration), "_user_n": tables.only(listed, tables.one())},
        splits=hot.user,
    )
    if genre_list is None:
        by_user = genres.with_genre_preference(by_user, None, hot.user)
    else:
        by_user = by_user.withColumn("user_genre_preference", genres.most_frequent(genre_list))
    return keyed_history(
        by_user,
        tables.CONTENT,
        prior={"_viewers": tables.first_view(), **tables.stop_sums(), **tables.session_sums("content")},
        splits=hot.content,
    )


def session_timing() -> dict[str, Column]:
    """Features of gaps and sessions; needs ``with_history`` and holds for rows with a release year."""
    ts = F.col("event_ts")
    return {
        "time_since_last_event": ts - F.col("prev_ts"),
        "time_since_last_event_user": ts - F.coalesce("_prev_user_ts", F.lit(0)),
        "time_since_last_completion": ts - F.coalesce("_prev_session_end", "session_end_ts"),
        "user_avg_session_duration": F.col("_duration_sum").cast("double") / F.col("_user_n"),
        "user_content_session_count": F.col("pair_sessions").cast("bigint"),
    }


def calendar_fields(as_of: Column) -> dict[str, Column]:
    """Features of the clock and of the content's and account's age; needs enriched events."""
    ts, released = F.col("event_ts"), F.col("release_year")
    return {
        "days_since_signup": scalar.days_between(ts, F.col("signup_date")),
        "content_age": F.year(as_of) - released,
        "hour_of_day": scalar.hour_of_day(ts),
        "day_of_week": scalar.day_of_week(ts),
        "content_age_at_event": scalar.year(ts) - released,
        "content_length_category": scalar.length_category(F.col("runtime")),
        "event_week_of_year": scalar.week_of_year(ts),
        "event_month_of_year": scalar.month_of_year(ts),
        "time_since_content_release": scalar.year(ts) - released,
        "playback_position_ratio": scalar.position_ratio(F.col("playback_position"), F.col("runtime")),
    }


def as_of_column(as_of: datetime.date | None) -> Column:
    """The given day, or today in UTC."""
    return scalar.utc_date(F.unix_millis(F.current_timestamp())) if as_of is None else F.lit(as_of)


def completion_prediction_features(
    enriched: DataFrame,
    genre_list: list[str] | None,
    as_of: datetime.date | None = None,
    hot: HotKeys = NO_HOT_KEYS,
) -> DataFrame:
    """The stored feature table. ``as_of`` is the day ``content_age`` counts to, today by default.

    Known leakage, kept because stored features and trained models depend on it:
    ``is_completion``, ``user_avg_session_duration`` and ``time_since_last_completion`` see events
    later than their own.
    """
    rows = with_history(enriched.drop("email"), genre_list, hot).filter(F.col("release_year").isNotNull())
    popularity = F.col("_viewers").cast("bigint")
    activity = F.col("_recent").cast("bigint")
    user_rate, content_rate = tables.completion_rate("user"), tables.completion_rate("content")
    view_ratio = tables.stop_ratio()
    columns = {
        "event_id": F.col("event_id"),
        "event_ts": F.col("event_ts"),
        "user_plan_tier": F.col("plan_tier"),
        "user_activity_level": activity,
        "user_content_engagement": F.when(F.col("_recent") > 0, tables.engagement()),
        "user_genre_preference": F.col("user_genre_preference"),
        "user_completion_rate": user_rate,
        "content_genre": F.col("genre"),
        "content_runtime": F.col("runtime"),
        "content_release_year": F.col("release_year"),
        "content_maturity_rating": F.col("maturity_rating"),
        "content_completion_rate": content_rate,
        "average_viewing_duration_ratio": view_ratio,
        "event_type": F.col("event_type"),
        "device": F.col("device"),
        "has_played_before": F.when(F.col("_earlier") > 0, 1).otherwise(0),
        "number_of_pauses": F.when(F.col("pauses_so_far") > 0, F.col("pauses_so_far").cast("bigint")),
        "is_completion": scalar.is_completion(
            F.col("is_completed_event"), F.col("stopped_near_end"), F.col("num_unique_events")
        ),
        "session_start_hour": scalar.hour_of_day(F.col("session_start_ts")),
        "session_start_dow": scalar.day_of_week(F.col("session_start_ts")),
        "content_popularity": popularity,
        "content_avg_view_duration_ratio": view_ratio,
        # The genre joined on is the event's own, so the lookup always returns that genre.
        "user_genre_recency": F.col("genre"),
        "user_activity_x_content_popularity": activity * popularity,
        "user_completion_x_content_completion": user_rate * content_rate,
        **session_timing(),
        **calendar_fields(as_of_column(as_of)),
    }
    return rows.select(*[columns[name].alias(name) for name in FEATURE_COLUMNS])
