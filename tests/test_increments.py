"""History in parts equals history over all events."""

import pytest
from frames import T0, enriched, random_events
from pyspark.sql import functions as F

from playthrough.functions.scalar import HISTORY_MS
from playthrough.operators import increments, tables
from playthrough.operators.history import keyed_history
from playthrough.operators.keysplits import find_splits

DAY = 86_400_000
NAMES = ["n", "stops", "recently", "before", "last_stop"]


@pytest.fixture
def user(spark):
    stop = F.col("event_type") == "stop"
    return increments.History(
        ("user_id",),
        {"n": tables.one(), "stops": F.when(stop, 1)},
        {"recently": tables.one()},
        {"before": F.col("event_ts"), "last_stop": F.when(stop, F.col("event_id"))},
        HISTORY_MS,
    )


def whole(events, history):
    return keyed_history(events, list(history.keys), prior=history.prior, recent=history.recent, lags=history.lags, span=history.span)


def rows(df):
    return sorted((r["event_id"], *[r[n] for n in NAMES]) for r in df.collect())


@pytest.mark.parametrize("days", [[20], [0, 1, 35, 36, 90], [20, 20]])
def test_parts_equal_the_whole(spark, tmp_path, user, days):
    """Cuts in the middle of a moment's events, before all, after all, twice at one moment."""
    events = enriched(spark, random_events(11, 300)).cache()
    bounds = [None, *[T0 + d * DAY for d in days], None]
    carried, found = None, []
    for k, (first, end) in enumerate(zip(bounds, bounds[1:])):
        new = events if first is None else events.filter(F.col("event_ts") >= first)
        new = new if end is None else new.filter(F.col("event_ts") < end)
        found += rows(increments.history_since(new, user, carried))
        if end is not None:
            carried = increments.carry(new, end, user, carried).save(str(tmp_path / str(k)))
    assert sorted(found) == rows(whole(events, user))


def test_what_is_carried_is_a_row_per_key_and_the_last_span(spark, user):
    events = enriched(spark, random_events(12, 300)).cache()
    until = T0 + 50 * DAY
    carried = increments.carry(events, until, user)
    assert carried.per_key.count() == events.filter(F.col("event_ts") < until).select("user_id").distinct().count()
    inside = events.filter((F.col("event_ts") < until) & (F.col("event_ts") >= until - HISTORY_MS))
    assert carried.events.count() == inside.count() > 0
    assert set(carried.events.columns) == {"user_id", "event_ts", "event_id", "recently"}


def test_hot_keys_of_a_part_are_cut(spark, user):
    events = enriched(spark, random_events(13, 300)).cache()
    until = T0 + 20 * DAY
    carried = increments.carry(events, until, user)
    new = events.filter(F.col("event_ts") >= until)
    splits = find_splits(new, ["user_id"], reach=HISTORY_MS, chunk_rows=40)
    assert splits.any_hot
    assert rows(increments.history_since(new, user, carried, splits)) == rows(whole(events, user).filter(F.col("event_ts") >= until))
