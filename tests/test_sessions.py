"""Session rules at their edges."""

from frames import T0, by_id, enriched, event

from playthrough.operators import sessions, tables

GAP = 30 * 60 * 1000


def starts(spark, *times):
    df = enriched(spark, [event(i, t) for i, t in enumerate(times)])
    found = by_id(sessions.session_identification(df), "session_start_ts")
    return [found[str(i)] for i in range(len(times))]


def test_gap_of_exactly_thirty_minutes_is_no_new_session(spark):
    assert starts(spark, T0, T0 + GAP) == [T0, T0]
    assert starts(spark, T0, T0 + GAP + 1) == [T0, T0 + GAP + 1]


def test_later_events_start_at_the_preceding_event(spark):
    assert starts(spark, T0, T0 + 10, T0 + 20, T0 + 30) == [T0, T0, T0 + 10, T0 + 20]


def test_after_timestamp_zero_a_session_starts(spark):
    assert starts(spark, 0, 1000) == [0, 1000]


def test_ties_go_by_event_id(spark):
    assert starts(spark, T0, T0, T0 + 5) == [T0, T0, T0]


def test_gap_sessions_stay_whole(spark):
    times = [T0, T0 + 10, T0 + 20, T0 + 20 + GAP + 1, T0 + 30 + GAP]
    df = enriched(spark, [event(i, t) for i, t in enumerate(times)])
    found = by_id(sessions.sessionize_gap(df), "session_start_ts")
    assert [found[str(i)] for i in range(5)] == [T0, T0, T0, times[3], times[3]]


def test_session_rollup(spark):
    df = enriched(
        spark,
        [
            event(0, T0, kind="play"),
            event(1, T0 + 1, kind="stop", position=95),
            event(2, T0, user="v", kind="stop", position=94),
            event(3, T0, user="w", kind="complete"),
            event(4, T0, user="x", kind="stop", position=95, runtime=0),
        ],
    )
    rows = sessions.content_completion(sessions.session_identification(df)).collect()
    found = {
        r["user_id"]: (r["session_end_ts"] - T0, r["is_completed_event"], r["stopped_near_end"], r["num_unique_events"])
        for r in rows
    }
    assert found == {"u": (1, 0, 1, 2), "v": (0, 0, 0, 1), "w": (0, 1, 0, 1), "x": (0, 0, 0, 1)}


def test_facts_agree_with_the_rollup(spark):
    from frames import random_events

    df = sessions.session_identification(enriched(spark, random_events(5, 300)))
    rolled = sessions.content_completion(df)
    facts = sessions.with_session_facts(df)
    columns = [*sessions.SESSION, "session_end_ts", "is_completed_event", "stopped_near_end", "num_unique_events"]
    spread = facts.select(*columns).distinct()
    assert spread.exceptAll(rolled.select(*columns)).count() == 0
    assert spread.count() == rolled.count()
    from pyspark.sql import functions as F

    assert facts.agg(F.sum(sessions.ends_session())).first()[0] == rolled.count()


def test_pauses_count_the_current_event_and_ties(spark):
    df = enriched(
        spark,
        [event(0, T0, kind="pause"), event(1, T0 + 1, kind="pause"), event(2, T0 + 1, kind="pause"), event(3, T0 + 2)],
    )
    # Session starts: 0 → T0, 1 → T0, 2 → T0 + 1 (event 1 precedes it), 3 → T0 + 1.
    assert by_id(tables.number_of_pauses(df), "number_of_pauses") == {"0": 1, "1": 2, "2": 1, "3": 1}
