"""Row rules, reasons, one row per id, keyed insert."""

import pytest
from frames import T0

from playthrough.operators import cleaning
from playthrough.schemas import EVENTS

GOOD = ("e", T0, "u", "c", "play", 5, "tv")
NAMES = EVENTS.fieldNames()


def row(**changes):
    return tuple(changes.get(name, value) for name, value in zip(NAMES, GOOD))


def reason(spark, schema=EVENTS, **changes):
    df = spark.createDataFrame([row(**changes)], schema)
    found = cleaning.with_reject_reason(df).first()["reject_reason"]
    assert cleaning.valid_events(df).count() == (found is None)
    return found


@pytest.mark.parametrize("column", cleaning.REQUIRED_TEXT)
def test_empty_text_is_missing(spark, column):
    assert reason(spark, **{column: ""}) == cleaning.MISSING


@pytest.mark.parametrize("column", ["user_id", "content_id", "event_type", "device", "event_ts", "playback_position"])
def test_null_is_missing(spark, column):
    assert reason(spark, **{column: None}) == cleaning.MISSING


@pytest.mark.parametrize("kind", cleaning.VALID_EVENT_TYPES)
def test_valid_types(spark, kind):
    assert reason(spark, event_type=kind) is None


@pytest.mark.parametrize("kind", ["PLAY", "Play", "error", " play"])
def test_invalid_types(spark, kind):
    assert reason(spark, event_type=kind) == cleaning.BAD_TYPE


def test_zero_passes_and_negative_does_not(spark):
    assert reason(spark, event_ts=0, playback_position=0) is None
    assert reason(spark, playback_position=-1) == cleaning.NEGATIVE


def test_first_failing_rule_gives_the_reason(spark):
    assert reason(spark, event_type="error", playback_position=-1) == cleaning.BAD_TYPE
    assert reason(spark, device="", playback_position=-1) == cleaning.MISSING


DOUBLES = (
    "event_id string, event_ts double, user_id string, content_id string, event_type string, "
    "playback_position double, device string"
)


@pytest.mark.parametrize("position, kept", [(-0.5, 0), (-1.0, None), (12.9, 12)])
def test_doubles_are_truncated_toward_zero(spark, position, kept):
    df = spark.createDataFrame([row(event_ts=float(T0) + 0.9, playback_position=position)], DOUBLES)
    found = [(r["event_ts"], r["playback_position"]) for r in cleaning.valid_events(df).collect()]
    assert found == ([] if kept is None else [(T0, kept)])


@pytest.mark.parametrize("value", [float("nan"), float("inf"), 1e30])
def test_unusable_numbers(spark, value):
    assert reason(spark, DOUBLES, event_ts=float(T0), playback_position=value) == cleaning.NOT_NUMERIC


def test_text_numbers(spark):
    schema = DOUBLES.replace("double", "string")
    assert reason(spark, schema, event_ts="9007199254740993", playback_position="abc") == cleaning.NOT_NUMERIC
    df = spark.createDataFrame([row(event_ts="9007199254740993", playback_position="3.7")], schema)
    found = cleaning.valid_events(df).first()
    assert (found["event_ts"], found["playback_position"]) == (9007199254740993, 3)


def test_oldest_row_of_an_id_wins(spark):
    df = spark.createDataFrame([row(event_ts=T0 + k) for k in (5, 3, 9)] + [row(event_id="f")], EVENTS)
    found = {r["event_id"]: r["event_ts"] for r in cleaning.clean_events(df).collect()}
    assert found == {"e": T0 + 3, "f": T0}


def test_an_invalid_copy_does_not_win(spark):
    df = spark.createDataFrame([row(event_ts=T0 - 1, device=""), row()], EVENTS)
    assert [r["event_ts"] for r in cleaning.clean_events(df).collect()] == [T0]


def test_oldest_events_only(spark):
    df = spark.createDataFrame([row(event_id=f"e{k}", event_ts=T0 + k) for k in range(9)], EVENTS)
    assert {r["event_id"] for r in cleaning.clean_events(df, max_rows=2).collect()} == {"e0", "e1"}


def test_counts_cover_all_rejected(spark):
    df = spark.createDataFrame([row(), row(device=""), row(event_type="x"), row(event_type="y")], EVENTS)
    found = {r["reject_reason"]: r["n_rows"] for r in cleaning.reject_counts(df).collect()}
    assert found == {cleaning.MISSING: 1, cleaning.BAD_TYPE: 2}


def test_rows_to_insert_skips_known_ids(spark):
    batch = spark.createDataFrame([row(), row(event_id="f"), row(event_id="f", event_ts=T0 + 1)], EVENTS)
    target = spark.createDataFrame([row(event_ts=1)], EVENTS)
    found = cleaning.rows_to_insert(batch, target).collect()
    assert [(r["event_id"], r["event_ts"]) for r in found] == [("f", T0)]


def test_cleaning_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.createDataFrame([row()], EVENTS).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = cleaning.valid_events(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters") :]
    for part in ["In(event_type", "GreaterThanOrEqual(playback_position,0)", "IsNotNull(event_ts)"]:
        assert part in pushed
