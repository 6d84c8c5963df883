"""Stored tables."""

import pytest
from pyspark.sql import functions as F
from frames import T0, enriched, random_events

from playthrough import schemas
from playthrough.schemas import CLEANED_EVENTS, EVENT_COLUMNS
from playthrough.sources import tables


@pytest.fixture
def names(spark):
    made = ["t_events", "t_users", "t_content", "t_saved"]
    drop = lambda: [spark.sql(f"DROP TABLE IF EXISTS {n}") for n in made]
    drop()
    yield made
    drop()


@pytest.fixture(scope="module", autouse=True)
def warehouse(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("warehouse")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS playthrough_test LOCATION '{folder}'")
    spark.sql("USE playthrough_test")
    yield
    spark.sql("USE default")
    spark.sql("DROP DATABASE playthrough_test CASCADE")


def event(i, ts=T0):
    return (i, ts, "u", "c", "play", 5, "tv")


def test_fixed_schemas_are_created_once(spark, names):
    for _ in range(2):
        tables.create_table(spark, "t_events", schemas.EVENTS)
        tables.create_table(spark, "t_users", schemas.USERS)
        tables.create_table(spark, "t_content", schemas.CONTENT)
    assert [f.dataType for f in spark.table("t_users").schema] == [f.dataType for f in schemas.USERS]
    assert spark.table("t_events").columns == schemas.EVENT_COLUMNS


def test_append_skips_stored_ids_and_is_repeatable(spark, names):
    tables.create_table(spark, "t_events", schemas.EVENTS)
    batch = spark.createDataFrame([event("a", T0 + 1), event("a"), event("b")], schemas.EVENTS)
    for _ in range(2):
        tables.append_new(batch, "t_events")
    tables.append_new(spark.createDataFrame([event("a", 1), event("c")], schemas.EVENTS), "t_events")
    found = sorted((r["event_id"], r["event_ts"]) for r in tables.load(spark, "SELECT * FROM t_events").collect())
    assert found == [("a", T0), ("b", T0), ("c", T0)]


def test_saving_replaces_or_keeps(spark, names):
    one, two = (spark.createDataFrame([(k,)], "k int") for k in (1, 2))
    tables.save_table(one, "t_saved")
    tables.save_table(two, "t_saved", replace=False)
    assert spark.table("t_saved").first()["k"] == 1
    tables.save_table(two, "t_saved")
    assert spark.table("t_saved").first()["k"] == 2


def test_features_are_stored_in_time_ranges(spark, tmp_path):
    path = str(tmp_path / "features")
    tables.by_time(enriched(spark, random_events(9, 300))).write.parquet(path)
    from pyspark.sql import functions as F

    ranges = (
        spark.read.parquet(path)
        .groupBy(F.input_file_name())
        .agg(F.min("event_ts").alias("a"), F.max("event_ts").alias("b"))
        .orderBy("a")
        .collect()
    )
    assert all(x["b"] <= y["a"] for x, y in zip(ranges, ranges[1:]))
    assert spark.read.parquet(path).count() == 300


def test_only_event_columns_are_read(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.createDataFrame([event("a")], schemas.EVENTS).selectExpr("*", "1 AS extra").write.parquet(path)
    df = tables.read_events(spark, path)
    assert df.columns == schemas.EVENT_COLUMNS
    assert "extra" not in df._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]


def test_database_scan_is_split_by_time(spark):
    reader = tables.jdbc_reader(spark, "jdbc:none:", "events", lower_ms=0, upper_ms=9, partitions=3, user="me")
    with pytest.raises(Exception, match="(?i)driver|jdbc"):  # no driver here
        reader.load()


def test_files_by_given_bounds(spark, tmp_path):
    """A moment with a third of the rows fills several ranges; every file is a range of time."""
    events = enriched(spark, random_events(9, 600))
    bounds = tables.time_bounds(events, 12)
    assert len(bounds) == 11 and bounds == sorted(bounds) and len(set(bounds)) < 11
    path = str(tmp_path / "t")
    tables.by_time(events, bounds).write.parquet(path)
    files = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("event_ts").alias("a"), F.max("event_ts").alias("b"), F.count("*").alias("n"))
    files = sorted((r["a"], r["b"], r["n"]) for r in files.collect())
    assert sum(n for *_, n in files) == 600 and len(files) > 6 and max(n for *_, n in files) < 200
    assert all(after[0] >= before[1] for before, after in zip(files, files[1:]))


def test_bounds_of_nothing(spark):
    none = enriched(spark, random_events(9, 5)).limit(0)
    assert tables.time_bounds(none, 4) == [] and tables.time_bounds(none, 1) == []
    assert tables.by_time(none, []).count() == 0
    assert tables.by_time(enriched(spark, random_events(9, 50)), []).count() == 50


def test_only_the_batch_is_shuffled_to_a_bucketed_table(spark, tmp_path):
    name = "bucketed_events"
    tables.create_table(spark, name, CLEANED_EVENTS, bucket_by="event_id", buckets=4, location=str(tmp_path / "b"))
    try:
        assert tables.bucket_count(spark, name, "event_id") == 4 and tables.bucket_count(spark, name, "user_id") is None
        batch = enriched(spark, random_events(3, 200)).select(*EVENT_COLUMNS)
        tables.append_new(batch.filter("event_ts % 3 = 0"), name)
        with_join = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
        before = {k: spark.conf.get(k) for k in with_join}
        for k, v in with_join.items():
            spark.conf.set(k, v)
        try:
            plan = tables.new_rows(batch, name)._jdf.queryExecution().executedPlan().toString()
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)
        batch_side, target_side = plan[: plan.rindex("Sort [")], plan[plan.rindex("Sort [") :]
        assert "SortMergeJoin" in plan and "Bucketed: true" in target_side, plan
        assert "Exchange" not in target_side and "Exchange" in batch_side, plan
        tables.append_new(batch.union(batch), name)
        assert spark.table(name).count() == spark.table(name).select("event_id").distinct().count() == 200
    finally:
        spark.sql(f"DROP TABLE {name}")
