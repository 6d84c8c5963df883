"""Fixed table schemas."""

from pyspark.sql import types as T

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.StringType(), False),
        T.StructField("event_ts", T.LongType()),  # epoch milliseconds, UTC
        T.StructField("user_id", T.StringType()),
        T.StructField("content_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("playback_position", T.IntegerType()),  # seconds
        T.StructField("device", T.StringType()),
    ]
)

CLEANED_EVENTS = EVENTS

USERS = T.StructType(
    [
        T.StructField("user_id", T.StringType(), False),
        T.StructField("email", T.StringType(), False),
        T.StructField("plan_tier", T.StringType(), False),
        T.StructField("signup_date", T.TimestampNTZType(), False),
    ]
)

CONTENT = T.StructType(
    [
        T.StructField("content_id", T.StringType(), False),
        T.StructField("genre", T.StringType(), False),
        T.StructField("runtime", T.IntegerType(), False),  # seconds
        T.StructField("release_year", T.IntegerType(), False),
        T.StructField("maturity_rating", T.StringType(), False),
    ]
)

ENRICHED = T.StructType(
    [
        T.StructField("event_id", T.StringType(), False),
        T.StructField("event_ts", T.LongType()),
        *USERS.fields,
        *CONTENT.fields,
        T.StructField("event_type", T.StringType()),
        T.StructField("playback_position", T.IntegerType()),
        T.StructField("device", T.StringType()),
    ]
)

EVENT_COLUMNS = EVENTS.fieldNames()
ENRICHED_COLUMNS = ENRICHED.fieldNames()

# The columns of completion_prediction_features, in stored order.
FEATURE_COLUMNS = [
    "event_id",
    "event_ts",
    "user_plan_tier",
    "days_since_signup",
    "user_activity_level",
    "user_content_engagement",
    "user_genre_preference",
    "user_completion_rate",
    "content_genre",
    "content_runtime",
    "content_release_year",
    "content_maturity_rating",
    "content_age",
    "content_completion_rate",
    "average_viewing_duration_ratio",
    "event_type",
    "playback_position_ratio",
    "device",
    "hour_of_day",
    "day_of_week",
    "time_since_last_event",
    "has_played_before",
    "number_of_pauses",
    "is_completion",
    "time_since_last_event_user",
    "time_since_last_completion",
    "user_avg_session_duration",
    "user_content_session_count",
    "session_start_hour",
    "session_start_dow",
    "content_popularity",
    "content_avg_view_duration_ratio",
    "content_age_at_event",
    "user_genre_recency",
    "content_length_category",
    "user_activity_x_content_popularity",
    "user_completion_x_content_completion",
    "event_week_of_year",
    "event_month_of_year",
    "time_since_content_release",
]
