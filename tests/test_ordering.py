"""Global positions and running totals."""

import random

import pytest
from frames import enriched, random_events
from pyspark.sql import functions as F

from playthrough.operators import ordering

ORDER = ["event_ts", "event_id"]


@pytest.mark.parametrize("k", [0, 1, 57, 498, 499])
@pytest.mark.parametrize("small", [3, 100_000])
def test_row_at_equals_sorting(spark, monkeypatch, k, small):
    monkeypatch.setattr(ordering, "SORT_AT_MOST", small)
    events = random_events(4, 500)
    want = sorted((e[1], e[0]) for e in events)[k]
    assert tuple(ordering.row_at(enriched(spark, events), ORDER, k)) == want


def test_row_at_with_pivots_from_a_thinned_sample(spark, monkeypatch):
    monkeypatch.setattr(ordering, "SORT_AT_MOST", 3)
    monkeypatch.setattr(ordering, "THINNED_TO", 50)
    events = random_events(4, 500)
    want = sorted((e[1], e[0]) for e in events)[300]
    assert tuple(ordering.row_at(enriched(spark, events), ORDER, 300)) == want


def test_row_past_the_end(spark):
    assert ordering.row_at(enriched(spark, random_events(4, 5)), ORDER, 5) is None


def test_repeated_values_are_refused(spark, monkeypatch):
    monkeypatch.setattr(ordering, "SORT_AT_MOST", 3)
    with pytest.raises(ValueError):
        ordering.row_at(spark.createDataFrame([(1,)] * 10, "x int"), ["x"], 2)


@pytest.mark.parametrize("n", [1, 4, 5, 103])
def test_split_has_exact_sizes_and_is_chronological(spark, n):
    events = random_events(6, n)
    train, test = ordering.chronological_split(enriched(spark, events))
    want = [i for _, i in sorted((e[1], e[0]) for e in events)]
    cut = int(n * 0.8)
    assert {r["event_id"] for r in train.collect()} == set(want[:cut])
    assert {r["event_id"] for r in test.collect()} == set(want[cut:])


def test_running_sums_over_several_ranges(spark):
    rng = random.Random(1)
    keys = rng.sample(range(100_000), 3000)
    data = [(k, rng.randrange(10), rng.randrange(10)) for k in keys]
    df = spark.createDataFrame(data, "k int, a int, b int").repartition(6)
    found = ordering.running_sums(df, "k", {"sum_a": "a"}, {"all_b": "b"}, {"next_a": "a", "next_b": "b"})
    got = {r["k"]: (r["sum_a"], r["all_b"], r["next_a"], r["next_b"]) for r in found.collect()}
    total, want, all_b = 0, {}, sum(b for _, _, b in data)
    data.sort()
    for row, after in zip(data, [*data[1:], (None, None, None)]):
        total += row[1]
        want[row[0]] = (total, all_b, after[1], after[2])
    assert got == want


def test_runs_over_the_oldest_keys_come_to_every_row_once(spark):
    import random

    rng = random.Random(6)
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, *"abcdefgh"]), k) for k in range(500)]
    df = spark.createDataFrame(rows, "event_ts bigint, event_id string, k int").repartition(4).cache()
    placed = [r for r in rows if r[0] is not None and r[1] is not None]
    keys = sorted({r[:2] for r in placed})
    cut, seen = None, []
    for run in range(0, len(keys), 60):
        batch, cut = ordering.next_oldest(df, cut, 60, sort_at_most=30)
        seen.append(sorted(tuple(r) for r in batch.collect()))
        assert {r[:2] for r in seen[-1]} == set(keys[run : run + 60])
        assert (cut is None) == (run + 60 >= len(keys))
    assert sorted(sum(seen, [])) == sorted(placed)


def test_intervals_between_pivots_by_halving(spark):
    for n in (0, 1, 2, 7, 64):
        points = [F.struct(F.lit(3 * k + 1).cast("bigint").alias("id")) for k in range(n)]
        found = spark.range(3 * n + 3).select("id", ordering._interval(points, F.struct("id")).alias("i")).collect()
        assert all(r["i"] == sum(3 * k + 1 <= r["id"] for k in range(n)) for r in found)
