"""Every operator as a query over the given test tables."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playthrough import schemas
from playthrough.functions import metrics, scalar
from playthrough.operators import cleaning, enrich, features, genres, increments, ordering, sessions, tables
from playthrough.operators.keysplits import CHUNK_ROWS
from playthrough.oracle import AS_OF
from playthrough.plans import jobs, model
from playthrough.sources import messages, testtables
from playthrough.sources import tables as store
from playthrough.sources.checkpoint import materialize, shared_folder, spread, stored
from playthrough.sources.commits import CommittedTable
from playthrough.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF_DATE = datetime.date.fromisoformat(AS_OF)
INSERT_CUTOFF_MS = 1705363200000  # 2024-01-16
#: Messages of later times arrive in later micro-batches; a minute after the hour, so that copies, a minute
#: late themselves, also fall into the batch after their original.
INGEST_BATCH_STARTS = (1704067260000, 1705363260000, 1706659260000)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


class Inputs:
    """The enriched events of one test folder, with the hot keys of its raw events."""

    def __init__(self, spark: SparkSession, sf_dir: str, chunk_rows: int = CHUNK_ROWS):
        self.raw = testtables.raw_events(spark, sf_dir)
        self.content = testtables.content_dim(spark, sf_dir)
        self.users = testtables.users_dim(spark, sf_dir)
        # The derived table holds a source row twice at most; counting the source reads no column.
        at_most = 2 * testtables.read(spark, sf_dir, "events").count()
        self.hot = features.find_hot_keys(self.raw, chunk_rows, n_rows=at_most)
        self.enriched = enrich.enriched_table(
            cleaning.clean_events(self.raw), self.users, self.content, self.hot.user, self.hot.content
        )

    def stored_with_genres(self, **changed: Column) -> tuple[DataFrame, list[str] | None]:
        """The enriched events as a stored table, as the job has them, some columns changed; and their genres."""
        enriched = stored(self.enriched.withColumns(changed) if changed else self.enriched)
        return enriched, genres.genre_names(enriched)


@query
def clean_events(spark, sf_dir):
    return cleaning.clean_events(testtables.raw_events(spark, sf_dir))


@query
def reject_counts(spark, sf_dir):
    return cleaning.reject_counts(testtables.raw_events(spark, sf_dir))


@query
def rejected_events(spark, sf_dir):
    return cleaning.rejected_events(testtables.raw_events(spark, sf_dir))


@query
def clean_oldest_events(spark, sf_dir):
    """Cleaning as a bounded batch of the oldest events."""
    return cleaning.clean_events(testtables.raw_events(spark, sf_dir), max_rows=10_000)


@query
def rows_to_insert(spark, sf_dir):
    """Cleaned events against a table that holds those of the first half month already."""
    events = cleaning.valid_events(testtables.raw_events(spark, sf_dir))
    return cleaning.rows_to_insert(events, events.filter(F.col("event_ts") < INSERT_CUTOFF_MS))


@query
def enriched_table(spark, sf_dir):
    return Inputs(spark, sf_dir).enriched


@query
def session_starts(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return sessions.session_starts(i.enriched, i.hot.user_content)


@query
def session_identification(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return sessions.session_identification(i.enriched, i.hot.user_content)


@query
def sessionize_gap(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    events = i.enriched.select("event_id", "user_id", "content_id", "event_ts")
    return sessions.sessionize_gap(events, i.hot.user_content)


@query
def content_completion(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return sessions.content_completion(sessions.session_identification(i.enriched, i.hot.user_content))


@query
def user_activity(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return tables.user_activity(i.enriched, i.hot.user)


@query
def user_engagement(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return tables.user_engagement(i.enriched, i.hot.user)


@query
def user_genre_preference(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    enriched, names = i.stored_with_genres()
    return tables.user_genre_preference(enriched, names, i.hot.user)


@query
def user_genre_preference_long(spark, sf_dir):
    """The way for more genres than counter columns."""
    i = Inputs(spark, sf_dir)
    return tables.user_genre_preference(i.enriched, None, i.hot.user)


@query
def user_genre_preference_long_hot_keys(spark, sf_dir):
    """That way with users and their genres cut."""
    i = Inputs(spark, sf_dir, chunk_rows=20)
    return tables.user_genre_preference(i.enriched, None, i.hot.user)


@query
def user_genre_preference_changed_titles(spark, sf_dir):
    """Some events kept a genre that no title has any more."""
    i = Inputs(spark, sf_dir)
    renamed = F.when(F.col("event_id").cast("bigint") % 3 == 0, "renamed").otherwise(F.col("genre"))
    enriched, names = i.stored_with_genres(genre=renamed)
    return tables.user_genre_preference(enriched, names, i.hot.user)


@query
def user_completion_rate(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return tables.user_completion_rate(i.enriched, i.hot.user, i.hot.user_content)


@query
def content_completion_rate(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return tables.content_completion_rate(i.enriched, i.hot.content, i.hot.user_content)


@query
def avg_view_duration_ratio(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return tables.avg_view_duration_ratio(i.enriched, i.hot.content)


@query
def has_played_before(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return tables.has_played_before(i.enriched, i.hot.user_content)


@query
def number_of_pauses(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return tables.number_of_pauses(i.enriched, i.hot.user_content)


@query
def content_popularity(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return tables.content_popularity(i.enriched, i.hot.content, i.hot.user_content)


def _carried_histories():
    user = {"user_activity_level": tables.one(), **tables.engagement_sums()}
    return [
        increments.History(("user_id",), {}, user, {}, scalar.HISTORY_MS),
        increments.History(("content_id",), tables.stop_sums(), {}, {}),
        increments.History(("user_id", "content_id"), {"_earlier": tables.one()}, {}, {"_prev": F.col("event_ts")}),
    ]


@query
def history_in_parts(spark, sf_dir):
    """Four runs over the events of a part of the time each, with what the runs before have left, read from files."""
    events = stored(Inputs(spark, sf_dir).enriched)
    histories = _carried_histories()
    carried = [None] * len(histories)
    bounds, parts = [None, *INGEST_BATCH_STARTS, None], None
    for first, end in zip(bounds, bounds[1:]):
        new = events if first is None else events.filter(F.col("event_ts") >= first)
        new = new if end is None else new.filter(F.col("event_ts") < end)
        rows = new
        for history, before in zip(histories, carried):
            rows = increments.history_since(rows, history, before)
        parts = rows if parts is None else parts.unionByName(rows)
        if end is not None:
            made = [increments.carry(new, end, h, before) for h, before in zip(histories, carried)]
            carried = [c.save(_new_folder(spark, "carry")) for c in made]
    return parts.select(
        "event_id",
        F.col("user_activity_level").cast("bigint").alias("user_activity_level"),
        F.when(F.col("user_activity_level") > 0, tables.engagement()).alias("user_content_engagement"),
        tables.stop_ratio().alias("average_viewing_duration_ratio"),
        F.when(F.col("_earlier") > 0, 1).otherwise(0).alias("has_played_before"),
        (F.col("event_ts") - F.coalesce("_prev", F.lit(0))).alias("time_since_last_event"),
    )


@query
def user_genre_recency(spark, sf_dir):
    return tables.user_genre_recency(Inputs(spark, sf_dir).enriched)


@query
def user_last_session_end(spark, sf_dir):
    return tables.user_last_session_end(content_completion(spark, sf_dir))


@query
def session_timing(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    rows = features.with_history(i.enriched, [], i.hot).filter(F.col("release_year").isNotNull())
    return rows.select("event_id", *[c.alias(name) for name, c in features.session_timing().items()])


@query
def calendar_fields(spark, sf_dir):
    enriched = Inputs(spark, sf_dir).enriched
    as_of = features.as_of_column(AS_OF_DATE)
    return enriched.select("event_id", *[c.alias(name) for name, c in features.calendar_fields(as_of).items()])


@query
def completion_prediction_features(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    enriched, names = i.stored_with_genres()
    return features.completion_prediction_features(enriched, names, AS_OF_DATE, i.hot)


@query
def completion_prediction_features_unknown_years(spark, sf_dir):
    """A title without a release year: its events count as history, but are no rows of the table."""
    i = Inputs(spark, sf_dir)
    known = F.when(F.col("content_id") != "3", F.col("release_year"))
    enriched, names = i.stored_with_genres(release_year=known)
    return features.completion_prediction_features(enriched, names, AS_OF_DATE, i.hot)


@query
def completion_prediction_features_hot_keys(spark, sf_dir):
    """The same with chunks of so few rows that users and titles are hot and get cut."""
    i = Inputs(spark, sf_dir, chunk_rows=50)
    enriched, names = i.stored_with_genres()
    return features.completion_prediction_features(enriched, names, AS_OF_DATE, i.hot)


@query
def completion_prediction_features_hot_pairs(spark, sf_dir):
    """With chunks so small that pairs of user and title are cut as well."""
    i = Inputs(spark, sf_dir, chunk_rows=10)
    enriched, names = i.stored_with_genres()
    return features.completion_prediction_features(enriched, names, AS_OF_DATE, i.hot)


def _scored(spark, sf_dir):
    """Label and a fixed score per event, to check metrics without a model."""
    i = Inputs(spark, sf_dir)
    facts = sessions.with_session_facts(
        sessions.session_identification(i.enriched, i.hot.user_content), i.hot.user_content
    )
    label = scalar.is_completion(F.col("is_completed_event"), F.col("stopped_near_end"), F.col("num_unique_events"))
    runtime = F.when(F.col("runtime") != 0, F.col("runtime")).cast("bigint")
    percent = F.least(F.lit(100), scalar.int_div(F.col("playback_position").cast("bigint") * 100, runtime))
    return facts.select(label.alias("label"), (percent.cast("double") / 100).alias("score"))


@query
def classification_report(spark, sf_dir):
    scored = _scored(spark, sf_dir).filter(F.col("score").isNotNull())
    return metrics.classification_report(scored.withColumn("prediction", F.when(F.col("score") > 0.5, 1).otherwise(0)))


@query
def roc_auc(spark, sf_dir):
    return metrics.roc_auc(_scored(spark, sf_dir))


@query
def average_precision(spark, sf_dir):
    return metrics.average_precision(_scored(spark, sf_dir))


@query
def roc_curve(spark, sf_dir):
    return metrics.roc_curve(_scored(spark, sf_dir))


@query
def pr_curve(spark, sf_dir):
    return metrics.pr_curve(_scored(spark, sf_dir))


@query
def class_weights(spark, sf_dir):
    return metrics.class_weights(_scored(spark, sf_dir))


@query
def chronological_split(spark, sf_dir):
    """Which events are for training, which for testing."""
    events = stored(Inputs(spark, sf_dir).enriched.select("event_id", "event_ts"))
    # So few sorted in one place that the cut is found by counting between pivots, as with many rows.
    cut = ordering.chronological_cut(events, sort_at_most=1000)
    before = ordering.is_before(cut, ["event_ts", "event_id"])
    return events.select("event_id", F.when(before, 1).otherwise(0).alias("is_train"))


def _new_folder(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _ingested(spark, sf_dir, remember_days=None):
    """Send all raw events as messages through the stream, in batches by time; some are cut short, some lack a key."""
    folder = _new_folder(spark, "ingest")
    raw = testtables.raw_events(spark, sf_dir)
    event = F.to_json(F.struct(*raw.columns))
    cut_short = F.col("playback_position") < 0
    lines = raw.select(
        "event_ts", F.when(cut_short, F.substr(event, F.lit(1), F.length(event) - 5)).otherwise(event).alias("value")
    )
    bounds = [None, *INGEST_BATCH_STARTS, None]
    for k, (first, end) in enumerate(zip(bounds, bounds[1:])):
        part = lines if first is None else lines.filter(F.col("event_ts") >= first)
        part = part if end is None else part.filter(F.col("event_ts") < end)
        part.select("value").write.text(f"{folder}/lines{k}")
        messages.publish(spark, f"{folder}/lines{k}", "text", path=f"{folder}/topic")
        running = ingest.ingest(
            messages.file_messages(spark, f"{folder}/topic"),
            table=f"{folder}/events",
            quarantine=f"{folder}/quarantine",
            checkpoint=f"{folder}/checkpoint",
            trigger=ingest.BACKLOG,
            remember_days=remember_days,
        )
        running.awaitTermination()
    return folder


@query
def streaming_ingest(spark, sf_dir):
    return ingest.stored_events(spark, _ingested(spark, sf_dir) + "/events").drop("arrival_day")


@query
def streaming_ingest_remembered(spark, sf_dir):
    """Ids are looked up among those that arrived since yesterday only."""
    return ingest.stored_events(spark, _ingested(spark, sf_dir, remember_days=1) + "/events").drop("arrival_day")


@query
def streaming_quarantine(spark, sf_dir):
    found = CommittedTable(spark, _ingested(spark, sf_dir) + "/quarantine").read()
    return found.groupBy("problem").agg(F.count(F.lit(1)).alias("n_messages"))


def _stored_features(spark, sf_dir, *columns):
    """The feature table, or some columns of it, in files of like size: it is made by title, of which there may be few."""
    table = completion_prediction_features(spark, sf_dir)
    return stored(spread(table.select(*columns) if columns else table, "event_id"))


@query
def one_hot_totals(spark, sf_dir):
    features_table = completion_prediction_features(spark, sf_dir)
    _, categorical = model.split_by_type(features_table.schema)
    return model.one_hot_totals(features_table, categorical)


@query
def predicted_completion(spark, sf_dir):
    """Train on the oldest four fifths of the features, score all of them."""
    rows = _stored_features(spark, sf_dir)
    train, _ = ordering.chronological_split(model.labelled(rows))
    return model.score(model.fit(train), rows)


@query
def predicted_from_enriched(spark, sf_dir):
    """Scoring of enriched events, which share only few columns with the features."""
    train, _ = ordering.chronological_split(model.labelled(_stored_features(spark, sf_dir)))
    fitted = model.fit(train)
    return model.score(fitted, model.align(Inputs(spark, sf_dir).enriched, fitted))


@query
def model_coefficients(spark, sf_dir):
    train, _ = ordering.chronological_split(model.labelled(_stored_features(spark, sf_dir)))
    return model.coefficients(spark, model.fit(train))


@query
def model_report(spark, sf_dir):
    _, evaluation = model.train_and_evaluate(_stored_features(spark, sf_dir))
    return evaluation.report


@query
def imputed_means(spark, sf_dir):
    """What stands in for nulls, to eight digits: means of the oldest four fifths."""
    train, _ = model.split(_stored_features(spark, sf_dir))
    means = model.imputed_means(train)
    return means.select("feature", F.format_string("%.7e", F.col("mean")).alias("mean"))


def _one_feature(spark, sf_dir):
    """Features of one 0/1 number, where the optimum without a penalty is known in closed form."""
    rows = _stored_features(spark, sf_dir, "event_id", "has_played_before", "is_completion")
    return rows, model.fit(model.labelled(rows), c=1e12, max_iter=200, tol=1e-12)


@query
def one_feature_regression(spark, sf_dir):
    _, fitted = _one_feature(spark, sf_dir)
    weights = model.coefficients(spark, fitted).select("feature", "coefficient")
    intercept = spark.createDataFrame([("(intercept)", float(fitted.stages[-1].intercept))], weights.schema)
    return weights.unionByName(intercept).select("feature", F.round("coefficient", 3).alias("coefficient"))


@query
def one_feature_predictions(spark, sf_dir):
    """The same model, saved and loaded, applied to all rows."""
    rows, fitted = _one_feature(spark, sf_dir)
    path = _new_folder(spark, "model")
    model.save(fitted, path)
    scored = model.score(model.load(path), rows)
    return scored.select("event_id", F.round(model.PROBABILITY, 3).alias(model.PROBABILITY))


@query
def aligned_for_model(spark, sf_dir):
    """Enriched events as the input of a model that knows three features, one of which they lack."""
    columns = ["event_id", "user_activity_level", "playback_position_ratio", "device", "is_completion"]
    fitted = model.fit(model.labelled(_stored_features(spark, sf_dir, *columns)), max_iter=1)
    ratio = scalar.position_ratio(F.col("playback_position"), F.col("runtime"))
    enriched = Inputs(spark, sf_dir).enriched.withColumn("playback_position_ratio", ratio)
    return model.align(enriched, fitted)


@query
def coefficient_names(spark, sf_dir):
    """Order and names of all coefficients: numbers in table order, then categories by name."""
    train, _ = model.split(_stored_features(spark, sf_dir))
    return model.coefficients(spark, model.fit(train, max_iter=1)).select("position", "feature")


@query
def model_gradient(spark, sf_dir):
    """How far each coefficient is from the optimum: the loss's slope, as a share of what the feature adds up to.

    Made from the features and the coefficients alone. The loss is convex, so no other coefficients have slope 0.
    """
    train, _ = model.split(_stored_features(spark, sf_dir))
    fitted = model.fit(train, tol=1e-13)
    numeric, categorical = model.model_inputs(fitted)
    means = fitted.stages[0].surrogateDF.first()
    weighted, _ = model.balanced(model.apply(fitted, train))
    error = F.col("class_weight") * (F.col(model.PROBABILITY) - F.col("label"))
    sums = []
    for r in model.coefficients(spark, fitted).collect():  # a row per feature
        name = r["feature"]
        if name in numeric:
            value = F.coalesce(F.col(name).cast("double"), F.lit(means[name]))
        else:
            column = next(c for c in categorical if name.startswith(f"{c}_"))
            value = F.when(F.col(column) == name.removeprefix(f"{column}_"), 1.0).otherwise(0.0)
        slope = F.sum(error * value) + r["coefficient"]
        sums.append(F.abs(slope / F.sum(F.col("class_weight") * F.abs(value))).alias(name))
    return weighted.agg(*sums).unpivot([], [*weighted.agg(*sums).columns], "feature", "slope").select(
        "feature", F.round("slope", 6).alias("slope")
    )


PENALISED = ["has_played_before", "playback_position_ratio"]


def _penalised(spark, sf_dir):
    """Two numbers, one with gaps, with class weights and a penalty that is felt."""
    rows = _stored_features(spark, sf_dir, "event_id", *PENALISED, "is_completion")
    gaps = F.when(F.col("event_id").cast("bigint") % 7 != 0, F.col(PENALISED[1])).alias(PENALISED[1])
    rows = rows.select("event_id", PENALISED[0], gaps, "is_completion")
    return rows, model.fit(model.labelled(rows), c=0.001, tol=1e-14)


@query
def penalised_regression(spark, sf_dir):
    _, fitted = _penalised(spark, sf_dir)
    weights = model.coefficients(spark, fitted).select("feature", "coefficient")
    intercept = spark.createDataFrame([("(intercept)", float(fitted.stages[-1].intercept))], weights.schema)
    return weights.unionByName(intercept).select("feature", F.round("coefficient", 6).alias("coefficient"))


@query
def penalised_predictions(spark, sf_dir):
    """The same model's predictions, saved and read again."""
    rows, fitted = _penalised(spark, sf_dir)
    path = _new_folder(spark, "predictions")
    store.save_predictions(model.score(fitted, rows), path)
    found = spark.read.parquet(path)
    return found.select("event_id", F.round(model.PROBABILITY, 6).alias(model.PROBABILITY))


def _new_table(spark, schema, **options):
    """A table of the catalog in a folder of its own."""
    name = f"playthrough_{uuid.uuid4().hex}"
    store.create_table(spark, name, schema, location=_new_folder(spark, "table"), **options)
    return name


@query
def inserted_by_key(spark, sf_dir):
    """Cleaned events, appended to a bucketed table of the catalog in three overlapping batches."""
    name = _new_table(spark, schemas.CLEANED_EVENTS, bucket_by="event_id", buckets=8)
    events = cleaning.clean_events(testtables.raw_events(spark, sf_dir))
    for until in (INGEST_BATCH_STARTS[1], INGEST_BATCH_STARTS[2], None):
        store.append_new(events if until is None else events.filter(F.col("event_ts") < until), name)
    return spark.table(name)


@query
def cleaned_in_runs(spark, sf_dir):
    """Cleaning in three runs, each over the oldest events that are left, and found by counting between pivots."""
    name = _new_table(spark, schemas.CLEANED_EVENTS, bucket_by="event_id", buckets=8)
    raw = materialize(testtables.raw_events(spark, sf_dir))
    n, cut = -(-raw.count() // 3), None
    while True:
        batch, cut = ordering.next_oldest(raw, cut, n, sort_at_most=1000)
        store.append_new(cleaning.valid_events(batch), name)
        if cut is None:
            return spark.table(name)


@query
def loaded_from_the_catalog(spark, sf_dir):
    """A stored result that is kept when it should not be replaced, read by a query."""
    name = f"playthrough_{uuid.uuid4().hex}"
    i = Inputs(spark, sf_dir)
    store.save_table(i.users.select("user_id", "plan_tier"), name)
    store.save_table(i.users.select("user_id", F.lit("none").alias("plan_tier")), name, replace=False)
    found = stored(store.load(spark, f"SELECT plan_tier, count(*) AS n_users FROM {name} GROUP BY plan_tier"))
    spark.sql(f"DROP TABLE {name}")
    return found


@query
def stored_time_ranges(spark, sf_dir):
    """Files of a table stored by time: how many rows, and how many files begin before the one before them ends."""
    enriched = stored(Inputs(spark, sf_dir).enriched)
    path = _new_folder(spark, "by-time")
    store.by_time(enriched, store.time_bounds(enriched, 12)).write.parquet(path)
    files = spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.min("event_ts").alias("low"), F.max("event_ts").alias("high")
    )
    before = F.max("high").over(Window.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1))  # a row per file
    return files.withColumn("overlap", F.col("low") < before).agg(
        F.sum("n").alias("n_rows"), F.count_if("overlap").alias("n_overlaps"), (F.count(F.lit(1)) > 6).alias("in_many_files")
    )


@query
def cleaning_counts(spark, sf_dir):
    """Rows read and kept, counted while the job's result is written."""
    raw, read = jobs.counted(testtables.raw_events(spark, sf_dir), f"read_{uuid.uuid4().hex}")
    valid, kept = jobs.counted(cleaning.valid_events(raw), f"valid_{uuid.uuid4().hex}")
    valid.write.parquet(_new_folder(spark, "valid"))
    (n_read,), (n_valid,) = read.get.values(), kept.get.values()
    return spark.createDataFrame([(n_read, n_valid)], "rows_read bigint, rows_valid bigint")
