"""Cutting hot keys into chunks changes no result."""

import datetime

import pytest
from pyspark.sql import functions as F
from frames import enriched, random_events

from playthrough.functions.scalar import HISTORY_MS
from playthrough.operators import features, keysplits, sessions, tables
from playthrough.operators.features import NO_HOT_KEYS, find_hot_keys
from playthrough.operators.history import keyed_history
from playthrough.operators.keysplits import KeySplits, find_splits, join_dimension

GENRES = ["g0", "g1", "g2"]
AS_OF = datetime.date(2025, 1, 1)


def same(a, b):
    assert a.columns == b.columns
    left, right = (sorted(map(repr, x.collect())) for x in (a, b))
    assert left == right


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark):
    df = enriched(spark, random_events(request.param, 500)).cache()
    return df, find_hot_keys(df, chunk_rows=15)


def test_everything_is_cut(case):
    _, hot = case
    assert hot.user.any_hot and hot.content.any_hot and hot.user_content.any_hot
    # The moment with a third of the rows is cut by id.
    for splits in (hot.user, hot.content, hot.user_content):
        assert any(r["_id_starts"] for r in splits.table.collect())


def test_chunks_are_balanced(case):
    df, hot = case
    from pyspark.sql import functions as F

    for splits in (hot.content, hot.user_content):
        rows = splits.assign(df, F.col("event_ts"), F.col("event_id"))
        largest = rows.groupBy(*splits.keys, "_chunk", "_sub").count().agg(F.max("count")).first()[0]
        assert largest <= 60  # 15 asked for; the cuts come from a sample


def test_feature_table(case):
    df, hot = case
    plain = features.completion_prediction_features(df, GENRES, AS_OF, NO_HOT_KEYS)
    same(features.completion_prediction_features(df, GENRES, AS_OF, hot), plain)


def test_feature_table_many_genres(case):
    df, hot = case
    plain = features.completion_prediction_features(df, GENRES, AS_OF, NO_HOT_KEYS)
    same(features.completion_prediction_features(df, None, AS_OF, hot), plain)


def test_gap_sessions(case):
    df, hot = case
    df = df.select("event_id", "user_id", "content_id", "event_ts")
    same(sessions.sessionize_gap(df, hot.user_content), sessions.sessionize_gap(df))


def test_single_tables(case):
    df, hot = case
    same(tables.user_activity(df, hot.user), tables.user_activity(df))
    same(tables.user_engagement(df, hot.user), tables.user_engagement(df))
    same(tables.content_popularity(df, hot.content, hot.user_content), tables.content_popularity(df))
    same(tables.number_of_pauses(df, hot.user_content), tables.number_of_pauses(df))


def test_only_one_kind_of_key_hot(case):
    df, hot = case
    plain = features.completion_prediction_features(df, GENRES, AS_OF, NO_HOT_KEYS)
    only_user = features.HotKeys(hot.user, NO_HOT_KEYS.content, NO_HOT_KEYS.user_content)
    same(features.completion_prediction_features(df, GENRES, AS_OF, only_user), plain)


def test_salted_join_keeps_rows(case, spark):
    df, hot = case
    events = df.select("event_id", "user_id", "event_ts")
    dim = spark.createDataFrame([(f"u{k}", k) for k in range(4)], "user_id string, k int")
    same(join_dimension(events, dim, "user_id", hot.user).select("event_id", "k"),
         join_dimension(events, dim, "user_id").select("event_id", "k"))


def test_chunks_do_not_grow_with_the_rows(spark):
    for n in (400, 4000):
        rows = spark.range(n).selectExpr("'u' user_id", "id event_ts", "cast(id as string) event_id")
        splits = find_splits(rows, ["user_id"], chunk_rows=40)
        cut = splits.assign(rows, F.col("event_ts"), F.col("event_id"))
        most = cut.groupBy("_chunk", "_sub").count().agg(F.max("count")).first()[0]
        assert most <= 4 * 40
        assert cut.select("_chunk").distinct().count() >= n / 80


def test_many_blocks(case, monkeypatch):
    monkeypatch.setattr(keysplits, "BLOCK", 4)
    df, _ = case
    splits = find_splits(df, ["content_id"], chunk_rows=1)
    assert max(len(r["_blocks"]) for r in splits.table.collect()) > 1
    same(tables.avg_view_duration_ratio(df, splits), tables.avg_view_duration_ratio(df))


def test_cuts_from_a_thinned_sample(case, monkeypatch):
    monkeypatch.setattr(keysplits, "THINNED_TO", 1)
    df, _ = case
    hot = find_hot_keys(df, chunk_rows=40)
    assert hot.user.any_hot and hot.content.any_hot
    same(tables.user_activity(df, hot.user), tables.user_activity(df))
    same(tables.avg_view_duration_ratio(df, hot.content), tables.avg_view_duration_ratio(df))


def test_small_input_is_not_cut(case):
    df, _ = case
    assert find_hot_keys(df) == NO_HOT_KEYS
    assert find_splits(df, ["user_id"]) == KeySplits(("user_id",))


def test_no_row_of_cuts_grows_with_the_chunks(spark):
    """A key of very many chunks, some of them cut by id: rows of at most a block, and the places that plain loops give."""
    n, per_moment = 6000, 30
    rows = spark.range(n).selectExpr("'u' user_id", f"id div {per_moment} event_ts", "lpad(id, 5, '0') event_id")
    splits = find_splits(rows, ["user_id"], chunk_rows=4)
    starts = [r["_blocks"] for r in splits.nodes[-1].collect()]
    assert sum(map(len, starts)) > 10 * keysplits.BLOCK
    assert all(len(r["_blocks"]) <= keysplits.BLOCK for t in (splits.table, *splits.nodes) for r in t.collect())
    in_order = sorted((tuple(s) for block in starts for s in block), key=lambda s: s[:2])
    found = splits.assign(rows, F.col("event_ts"), F.col("event_id")).collect()
    assert len(found) == n
    for r in found:
        before = [s for s in in_order if s[:2] <= (r["event_ts"], r["event_id"])]
        assert (r["_chunk"], r["_sub"]) == (before[-1][2:] if before else (0, 0))


def test_tables_of_hot_pairs_carry_no_broadcast_hint(case):
    df, hot = case
    marked = sessions.session_identification(df, hot.user_content)
    facts = sessions.with_session_facts(marked, hot.user_content)
    same(facts, sessions.with_session_facts(marked))
    plan = facts._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint (strategy=broadcast)" not in plan


def _few_hot_events(spark):
    return spark.range(300).selectExpr("'u' user_id", "'c' content_id", "id event_ts", "cast(id as string) event_id", "id more")


def test_events_are_made_once_to_find_hot_keys(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(event_id):
        made.add(1)
        return event_id

    hot = find_hot_keys(_few_hot_events(spark).withColumn("event_id", counted("event_id")), chunk_rows=50, n_rows=300)
    assert hot.user.any_hot and hot.content.any_hot and hot.user_content.any_hot
    assert made.value == 300


def test_windows_over_chunks_do_not_take_the_other_columns_apart(spark):
    rows = _few_hot_events(spark).withColumns({f"more{k}": F.col("more") + k for k in range(20)})
    splits = find_splits(rows, ["user_id"], chunk_rows=50)
    found = keyed_history(
        rows, ["user_id"], prior={"n": F.lit(1)}, recent={"r": F.lit(1)}, span=10, lags={"l": F.col("more")}, splits=splits
    )
    shuffled = found._jdf.queryExecution().optimizedPlan().collectLeaves().head().output().mkString(",")
    assert "_payload#" in shuffled and "more" not in shuffled
    for r in found.collect():
        t = r["event_ts"]
        assert (r["more"], r["more7"], r["n"], r["r"], r["l"]) == (t, t + 7, t, min(t, 10), t - 1 if t else None)
