"""Point-in-time frames against a plain loop, and at their edges."""

import datetime
from collections import Counter

import pytest
from frames import T0, by_id, enriched, event, random_events

from playthrough.operators import features, tables
from playthrough.operators.genres import genre_names

DAYS_30 = 30 * 24 * 60 * 60 * 1000
AS_OF = datetime.date(2025, 1, 1)


def test_thirty_days_are_included_and_the_same_moment_is_not(spark):
    df = enriched(
        spark, [event("old", T0), event("edge", T0 + 1), event("tie", T0 + 1 + DAYS_30), event("now", T0 + 1 + DAYS_30)]
    )
    assert by_id(tables.user_activity(df), "user_activity_level") == {"old": 0, "edge": 1, "tie": 1, "now": 1}


def test_cold_start(spark):
    df = enriched(spark, [event("a", T0)])
    row = features.completion_prediction_features(df, ["drama"], AS_OF).first()
    assert row["user_activity_level"] == 0 and row["user_completion_rate"] == 0.0
    assert row["content_completion_rate"] == 0.0 and row["content_popularity"] == 0
    for column in ["user_content_engagement", "user_genre_preference", "average_viewing_duration_ratio", "number_of_pauses"]:
        assert row[column] is None
    assert row["time_since_last_event"] == T0 and row["time_since_last_event_user"] == T0
    assert row["time_since_last_completion"] == 0
    assert tables.user_engagement(df).count() == 0


def test_genre_ties_go_to_the_smaller_name(spark):
    df = enriched(
        spark,
        [event("a", T0, content="x", genre="west"), event("b", T0 + 1, content="y", genre="art"), event("c", T0 + 2)],
    )
    found = by_id(tables.user_genre_preference(df, ["west", "art", "drama"]), "user_genre_preference")
    assert found == {"a": None, "b": "west", "c": "art"}


def test_genre_list_limit(spark):
    few = spark.createDataFrame([("a",), ("b",), (None,)], "genre string")
    assert sorted(genre_names(few)) == ["a", "b"]
    many = spark.range(200).selectExpr("cast(id AS string) AS genre")
    assert genre_names(many) is None


def test_zero_runtime_gives_null_not_an_error(spark):
    df = enriched(spark, [event("a", T0, runtime=0, kind="stop"), event("b", T0 + 1, runtime=0)])
    rows = {r["event_id"]: r for r in features.completion_prediction_features(df, ["drama"], AS_OF).collect()}
    assert rows["b"]["playback_position_ratio"] is None
    assert rows["b"]["average_viewing_duration_ratio"] is None and rows["b"]["user_content_engagement"] is None
    assert rows["b"]["user_activity_level"] == 1
    assert tables.user_engagement(df).count() == 1


def clock(spark, ts, **changes):
    df = enriched(spark, [event("a", ts, **changes)])
    return features.completion_prediction_features(df, ["drama"], AS_OF).first()


def ms(*args):
    return int(datetime.datetime(*args, tzinfo=datetime.timezone.utc).timestamp() * 1000)


def test_sunday_is_zero(spark):
    assert clock(spark, ms(2024, 1, 7))["day_of_week"] == 0
    assert clock(spark, ms(2024, 1, 13, 23, 59))["day_of_week"] == 6


def test_iso_week(spark):
    row = clock(spark, ms(2021, 1, 3, 5))
    assert (row["event_week_of_year"], row["event_month_of_year"], row["hour_of_day"]) == (53, 1, 5)


@pytest.mark.parametrize("runtime, category", [(1199, "short"), (1200, "medium"), (3600, "medium"), (3601, "long")])
def test_length_category(spark, runtime, category):
    assert clock(spark, T0, runtime=runtime)["content_length_category"] == category


@pytest.mark.parametrize(
    "signup, days",
    [
        (datetime.datetime(2024, 1, 1, 0, 0, 0), 0),
        (datetime.datetime(2024, 1, 1, 0, 0, 0, 1000), -1),
        (datetime.datetime(2023, 12, 31, 0, 0, 0, 1), 0),
        (datetime.datetime(2023, 12, 31), 1),
        (datetime.datetime(1969, 12, 31, 12), 19723),
    ],
)
def test_days_since_signup(spark, signup, days):
    assert clock(spark, T0, signup=signup)["days_since_signup"] == days


def test_calendar_does_not_depend_on_the_session_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    expected = clock(spark, ms(2024, 1, 7, 0, 30))
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert clock(spark, ms(2024, 1, 7, 0, 30)) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_ages(spark):
    row = clock(spark, ms(2024, 6, 1), year=2000)
    assert (row["content_age"], row["content_age_at_event"], row["time_since_content_release"]) == (25, 24, 24)


def test_age_counts_to_this_year_by_default(spark):
    df = enriched(spark, [event("a", T0, year=2000)])
    row = features.completion_prediction_features(df, ["drama"]).first()
    assert row["content_age"] == datetime.datetime.now(datetime.timezone.utc).year - 2000


def test_a_near_end_stop_alone_is_no_completion(spark):
    alone = clock(spark, T0, kind="stop", position=95)
    assert alone["is_completion"] == 0
    df = enriched(spark, [event("a", T0), event("b", T0 + 1, kind="stop", position=95)])
    found = by_id(features.completion_prediction_features(df, ["drama"], AS_OF), "is_completion")
    assert found == {"a": 1, "b": 1}


def loop(events):
    """user_activity, engagement sums, genre and popularity of every event, the slow way."""
    rows = [dict(zip(["id", "ts", "user"], e[:3]), content=e[6], genre=e[7], runtime=e[8], kind=e[11], at=e[12]) for e in events]
    for e in rows:
        past = [p for p in rows if p["user"] == e["user"] and e["ts"] - DAYS_30 <= p["ts"] < e["ts"]]
        title = [p for p in rows if p["content"] == e["content"] and p["ts"] < e["ts"]]
        counts = Counter(p["genre"] for p in past)
        ratios = [p["at"] / p["runtime"] for p in past if p["runtime"]]
        stops = [p["at"] / p["runtime"] for p in title if p["kind"] == "stop" and p["runtime"]]
        yield e["id"], {
            "user_activity_level": len(past),
            "user_content_engagement": sum(ratios) / len(ratios) if ratios else None,
            "user_genre_preference": min(counts, key=lambda g: (-counts[g], g)) if counts else None,
            "content_popularity": len({p["user"] for p in title}),
            "average_viewing_duration_ratio": sum(stops) / len(stops) if stops else None,
            "has_played_before": int(any(p["user"] == e["user"] for p in title)),
        }


@pytest.mark.parametrize("seed", [11, 12])
def test_against_a_loop(spark, seed):
    events = random_events(seed, 250)
    df = enriched(spark, events)
    found = {r["event_id"]: r for r in features.completion_prediction_features(df, ["g0", "g1", "g2"], AS_OF).collect()}
    assert len(found) == 250
    for i, want in loop(events):
        for name, value in want.items():
            got = found[i][name]
            assert got == (pytest.approx(value, abs=1e-8) if isinstance(value, float) else value), (i, name)


def test_results_do_not_depend_on_partitioning(spark):
    df = enriched(spark, random_events(3, 200))
    a, b = (
        sorted(features.completion_prediction_features(x, ["g0", "g1", "g2"], AS_OF).collect())
        for x in (df.coalesce(1), df.repartition(7))
    )
    assert list(map(tuple, a)) == list(map(tuple, b))


@pytest.mark.parametrize("table", [tables.user_completion_rate, tables.content_completion_rate, tables.content_popularity])
def test_tables_over_pairs_and_one_key_shuffle_once(spark, tmp_path, table):
    path = str(tmp_path / "enriched")
    enriched(spark, random_events(3, 50)).write.parquet(path)
    plan = table(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_the_plan_shuffles_twice(spark, tmp_path):
    path = str(tmp_path / "enriched")
    enriched(spark, random_events(3, 50)).write.parquet(path)
    df = features.completion_prediction_features(spark.read.parquet(path), ["g0", "g1", "g2"], AS_OF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("Sort [") == 4
    assert "Join" not in plan
    assert "email" not in plan[plan.index("ReadSchema") :]


@pytest.mark.parametrize("chunk_rows", [10**6, 40])
def test_preference_by_changes_equals_counting(spark, chunk_rows):
    """Ties, gaps of exactly thirty days, genres that come and go; with users cut into chunks and without."""
    import random

    from playthrough.functions.scalar import HISTORY_MS
    from playthrough.operators.genres import with_genre_preference
    from playthrough.operators.keysplits import find_splits

    rng = random.Random(4)
    names = [None, *[f"g{k}" for k in range(40)]]
    rows = []
    for i in range(700):
        user = "u0" if rng.random() < 0.6 else f"u{rng.randrange(1, 9)}"
        ts = rng.choice([0, HISTORY_MS // 2]) + HISTORY_MS // 6 * rng.randrange(12) + rng.choice([0, 0, 1])
        rows.append((f"e{i}", ts, user, rng.choice(names[:4]) if rng.random() < 0.5 else rng.choice(names)))
    events = spark.createDataFrame(rows, "event_id string, event_ts bigint, user_id string, genre string").repartition(5)
    splits = find_splits(events, ["user_id"], reach=HISTORY_MS, chunk_rows=chunk_rows)
    assert splits.any_hot == (chunk_rows == 40)
    got = {r["event_id"]: r["user_genre_preference"] for r in with_genre_preference(events, None, splits).collect()}
    assert len(got) == 700
    for i, ts, user, _ in rows:
        counts = {}
        for _, t, u, g in rows:
            if u == user and g is not None and ts - HISTORY_MS <= t < ts:
                counts[g] = counts.get(g, 0) + 1
        assert got[i] == (min(counts, key=lambda g: (-counts[g], g)) if counts else None), (i, ts, user)
