"""All jobs, one after the other, over stored tables."""

import datetime

import pytest
from check_oracle import connect, rows_of

from playthrough import oracle, schemas
from playthrough.__main__ import main, parser
from playthrough.operators import cleaning
from playthrough.plans import jobs
from playthrough.sources import testtables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("warehouse")
    spark.sql(f"CREATE DATABASE playthrough_jobs LOCATION '{folder}'")
    spark.sql("USE playthrough_jobs")
    jobs.create_inputs(spark)
    testtables.raw_events(spark, SF).write.insertInto(jobs.RAW)
    testtables.users_dim(spark, SF).write.insertInto(jobs.USERS)
    testtables.content_dim(spark, SF).write.insertInto(jobs.CONTENT)
    yield folder
    spark.sql("USE default")
    spark.sql("DROP DATABASE playthrough_jobs CASCADE")


def stored(spark, name):
    df = spark.table(name)
    return rows_of(df.columns, df.collect())


def expected(name):
    cur = connect(SF).execute(oracle.SQL[name])
    return rows_of([d[0] for d in cur.description], cur.fetchall())


def test_batch_run(spark, database):
    raw = spark.table(jobs.RAW)
    assert jobs.clean(spark) == {"rows_read": raw.count(), "rows_valid": cleaning.valid_events(raw).count()}
    assert stored(spark, jobs.CLEANED) == expected("clean_events")
    main(["clean", "--keep-rejected"])
    assert stored(spark, jobs.CLEANED) == expected("clean_events")
    assert stored(spark, jobs.REJECTED) == expected("rejected_events")
    main(["enrich"])
    assert stored(spark, jobs.ENRICHED) == expected("enriched_table")
    assert spark.table(jobs.ENRICHED).columns == schemas.ENRICHED_COLUMNS
    main(["features", "--as-of", oracle.AS_OF, "--intermediates"])
    assert spark.table(jobs.FEATURES).columns == schemas.FEATURE_COLUMNS
    enriched = spark.table(jobs.ENRICHED)
    names = [*jobs.session_tables(enriched), "content_completion", *jobs.history_tables(enriched, []), jobs.FEATURES]
    assert len(names) == 12
    for name in names:
        assert stored(spark, name) == expected(name), name

    path, out = str(database / "model"), str(database / "predictions")
    evaluation = jobs.train(spark, path)
    assert evaluation.report.count() == 5
    main(["score", path, out])
    predictions = spark.read.parquet(out)
    assert predictions.columns == ["event_id", "predicted_completion_probability"]
    assert predictions.count() == spark.table(jobs.FEATURES).count()
    main(["score", path, out, "--query", f"SELECT * FROM {jobs.ENRICHED}"])
    assert spark.read.parquet(out).count() == spark.table(jobs.ENRICHED).count()


def test_cleaning_in_runs_over_the_oldest(spark, database):
    """Runs until nothing is left give what one run gives; a further run reads the last events again and adds none."""
    spark.sql(f"DROP TABLE {jobs.CLEANED}")
    n = spark.table(jobs.RAW).select("event_ts", "event_id").distinct().count()
    for _ in range(3):
        main(["clean", "--oldest", str(n // 3 + 1)])
    assert stored(spark, jobs.CLEANED) == expected("clean_events")
    assert spark.table(jobs.CUT).count() == 2
    assert jobs.clean_oldest(spark, n)["rows_read"] <= n // 3 + 1
    assert stored(spark, jobs.CLEANED) == expected("clean_events")


def test_an_existing_table_can_be_kept(spark, database):
    before = stored(spark, jobs.ENRICHED)
    spark.sql(f"INSERT INTO {jobs.CLEANED} SELECT 'new', event_ts, user_id, content_id, event_type, "
              f"playback_position, device FROM {jobs.CLEANED} LIMIT 1")  # fmt: skip
    jobs.enrich_events(spark, replace=False)
    assert stored(spark, jobs.ENRICHED) == before
    jobs.enrich_events(spark)
    assert len(stored(spark, jobs.ENRICHED)[1]) == len(before[1]) + 1


def test_arguments():
    a = parser().parse_args(["features", "--as-of", "2024-02-29"])
    assert a.as_of == datetime.date(2024, 2, 29) and not a.intermediates
    assert not parser().parse_args(["clean"]).keep_rejected
