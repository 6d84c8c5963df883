"""The batch jobs over stored tables, in the order they are run.

``clean`` → ``enrich`` → ``features`` → ``train`` → ``score``. Each reads tables of the catalog and
stores its result there, so every job can be repeated by itself.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playthrough import schemas
from playthrough.operators import cleaning, enrich, genres, ordering, sessions, tables
from playthrough.operators import features as feature_table
from playthrough.plans import model
from playthrough.sources import tables as store

RAW, CLEANED, USERS, CONTENT = "events_table", "cleaned_events", "users_dim", "content_dim"
REJECTED, CUT = "rejected_events", "cleaned_until"
ENRICHED, FEATURES = "enriched_table", "completion_prediction_features"


def create_inputs(spark: SparkSession) -> None:
    store.create_table(spark, RAW, schemas.EVENTS)
    store.create_table(spark, USERS, schemas.USERS)
    store.create_table(spark, CONTENT, schemas.CONTENT)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with its rows counted on the way, by whatever action runs over it."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias(name)), seen


def clean(spark: SparkSession, keep_rejected: bool = False) -> dict[str, int]:
    """Add the valid raw events whose id is new to the cleaned ones.

    ``keep_rejected`` stores the other rows, each with its reason. Returns how many rows were read and
    how many of them were valid.
    """
    store.create_table(spark, CLEANED, schemas.CLEANED_EVENTS, bucket_by="event_id")
    raw = spark.table(RAW).select(*schemas.EVENT_COLUMNS)
    if keep_rejected:
        store.save_table(cleaning.rejected_events(raw), REJECTED)
    raw, read = counted(raw, "rows_read")
    valid, kept = counted(cleaning.valid_events(raw), "rows_valid")
    store.append_new(valid, CLEANED)
    return {**read.get, **kept.get}


def clean_oldest(spark: SparkSession, max_keys: int) -> dict[str, int]:
    """Like ``clean``, for the oldest events that no run has come to yet.

    Where the next run goes on is stored, so repeated runs come to every event once. The cut is stored after the
    events: a run that is broken off is done again, and what it has added is not added twice. What arrives with a time
    before the cut is left to ``clean``.
    """
    store.create_table(spark, CLEANED, schemas.CLEANED_EVENTS, bucket_by="event_id")
    store.create_table(spark, CUT, T.StructType([schemas.EVENTS["event_ts"], schemas.EVENTS["event_id"]]))
    raw = spark.table(RAW).select(*schemas.EVENT_COLUMNS)
    last = spark.table(CUT).orderBy(F.desc("event_ts"), F.desc("event_id")).first()  # a row per run
    batch, cut = ordering.next_oldest(raw, last, max_keys)
    batch, read = counted(batch, "rows_read")
    valid, kept = counted(cleaning.valid_events(batch), "rows_valid")
    store.append_new(valid, CLEANED)
    if cut is not None:
        spark.createDataFrame([tuple(cut)], spark.table(CUT).schema).write.insertInto(CUT)
    return {**read.get, **kept.get}


def enrich_events(spark: SparkSession, replace: bool = True) -> None:
    events = spark.table(CLEANED)
    hot = feature_table.find_hot_keys(events)
    enriched = enrich.enriched_table(events, spark.table(USERS), spark.table(CONTENT), hot.user, hot.content)
    store.save_table(enriched, ENRICHED, replace)


def session_tables(
    enriched: DataFrame, hot: feature_table.HotKeys = feature_table.NO_HOT_KEYS
) -> dict[str, DataFrame]:
    """Sessions of the events, by name of the table."""
    pair = hot.user_content
    return {
        "session_starts": sessions.session_starts(enriched, pair),
        "session_identification": sessions.session_identification(enriched, pair),
    }


def history_tables(
    enriched: DataFrame, genre_list: list[str] | None, hot: feature_table.HotKeys = feature_table.NO_HOT_KEYS
) -> dict[str, DataFrame]:
    """The point-in-time tables behind the feature table, by name. The feature table does not need them stored."""
    pair = hot.user_content
    return {
        "user_activity": tables.user_activity(enriched, hot.user),
        "user_engagement": tables.user_engagement(enriched, hot.user),
        "user_genre_preference": tables.user_genre_preference(enriched, genre_list, hot.user),
        "user_completion_rate": tables.user_completion_rate(enriched, hot.user, pair),
        "content_completion_rate": tables.content_completion_rate(enriched, hot.content, pair),
        "avg_view_duration_ratio": tables.avg_view_duration_ratio(enriched, hot.content),
        "has_played_before": tables.has_played_before(enriched, pair),
        "number_of_pauses": tables.number_of_pauses(enriched, pair),
    }


def features(
    spark: SparkSession,
    as_of: datetime.date | None = None,
    intermediates: bool = False,
    replace: bool = True,
    ranges: int | None = None,
) -> None:
    """``ranges`` of time are stored, each a file; as many as a shuffle has partitions by default."""
    enriched = spark.table(ENRICHED)
    hot = feature_table.find_hot_keys(enriched)
    genre_list = genres.genre_names(enriched)
    if intermediates:
        for name, table in session_tables(enriched, hot).items():
            store.save_table(table, name, replace)
        # From the sessions just stored.
        completion = sessions.content_completion(spark.table("session_identification"))
        store.save_table(completion, "content_completion", replace)
        for name, table in history_tables(enriched, genre_list, hot).items():
            store.save_table(table, name, replace)
    final = feature_table.completion_prediction_features(enriched, genre_list, as_of, hot)
    # The features have the events' moments, and those are stored.
    bounds = store.time_bounds(enriched, ranges or int(spark.conf.get("spark.sql.shuffle.partitions")))
    store.save_table(store.by_time(final, bounds), FEATURES, replace)


def train(spark: SparkSession, model_path: str, test_size: float = 0.2) -> model.Evaluation:
    """Fit on the oldest features, save the model, evaluate on the newest."""
    fitted, evaluation = model.train_and_evaluate(store.load(spark, f"SELECT * FROM {FEATURES}"), test_size)
    model.save(fitted, model_path)
    return evaluation


def score(spark: SparkSession, model_path: str, out: str, query: str = f"SELECT * FROM {FEATURES}") -> None:
    """Predictions for the rows of any query with an ``event_id``; missing columns count as zero."""
    fitted = model.load(model_path)
    rows = store.load(spark, query)
    numeric, categorical = model.model_inputs(fitted)
    if not set(numeric + categorical) <= set(rows.columns):
        rows = model.align(rows, fitted)
    store.save_predictions(model.score(fitted, rows), out)
