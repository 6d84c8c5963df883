"""Stored tables: read, create, replace, append by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playthrough.operators.cleaning import first_per_event_id, rows_to_insert
from playthrough.schemas import EVENT_COLUMNS


BUCKETS = 64
#: Bounds are looked up in two steps: block, then bound within the block.
BLOCK = 64


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Exactly the event columns of a Parquet table."""
    return spark.read.parquet(path).select(*EVENT_COLUMNS)


def jdbc_reader(
    spark: SparkSession, url: str, table: str, *, lower_ms: int, upper_ms: int, partitions: int, **options: str
) -> DataFrameReader:
    """Reader of an event table in a database, split by ``event_ts`` into parallel range queries.

    Call ``.load()`` on it; needs the database's JDBC driver on the class path. The bounds only set
    the split points, rows outside them are read too.
    """
    split = {
        "partitionColumn": "event_ts",
        "lowerBound": str(lower_ms),
        "upperBound": str(upper_ms),
        "numPartitions": str(partitions),
    }
    return spark.read.format("jdbc").options(url=url, dbtable=table, **split, **options)


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    *,
    bucket_by: str | None = None,
    buckets: int = BUCKETS,
    location: str | None = None,
) -> None:
    """An empty table of a fixed schema, unless it is there already.

    With ``bucket_by`` its rows lie in files by the hash of that column, so that a join by it reads them where they are.
    """
    columns = ", ".join(
        f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields
    )
    clustered = f" CLUSTERED BY ({bucket_by}) INTO {buckets} BUCKETS" if bucket_by else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{clustered}{place}")


def bucket_count(spark: SparkSession, name: str, column: str) -> int | None:
    """The number of buckets of a table that is bucketed by this one column, else None."""
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}  # a row per property
    by = (about.get("Bucket Columns") or "").strip("[]`")
    return int(about["Num Buckets"]) if by == column else None


def save_table(df: DataFrame, name: str, replace: bool = True) -> None:
    """Store a result. ``replace=False`` leaves an existing table as it is, however stale."""
    df.write.mode("overwrite" if replace else "ignore").format("parquet").saveAsTable(name)


def time_bounds(events: DataFrame, ranges: int) -> list[int]:
    """Moments that cut the events into ranges of about equal size; one with very many events comes up several times."""
    shares = [k / ranges for k in range(1, ranges)]
    if not shares:
        return []
    found = events.agg(F.percentile_approx("event_ts", shares, max(10_000, 20 * ranges)).alias("bounds")).first()["bounds"]
    return sorted(found or [])


def by_time(df: DataFrame, bounds: list[int] | None = None) -> DataFrame:
    """Partitions that hold neighbouring ranges of ``event_ts``, each sorted.

    A reader of one period of the stored table then skips the other files; nothing is sorted in one
    task. The bounds are known, so the rows are made once: a range partitioning would make them a second time, to
    sample them. A moment that fills several ranges is dealt to them by its event ids. Without bounds they are taken
    from ``df`` itself.
    """
    if bounds is None:
        bounds = time_bounds(df, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    blocks = [bounds[k : k + BLOCK] for k in range(0, len(bounds), BLOCK)] or [[]]
    table = F.array(*[F.array(*[F.lit(b).cast("bigint") for b in block]).cast("array<bigint>") for block in blocks])
    firsts = F.array(*[F.lit(block[0] if block else None).cast("bigint") for block in blocks])
    ts = F.col("event_ts")

    def before(or_at: bool):
        """How many bounds lie before the moment, or at it: the full blocks, and some of the last."""
        met = (lambda b: b <= ts) if or_at else (lambda b: b < ts)
        full = F.greatest(F.size(F.filter(firsts, met)) - 1, F.lit(0))
        return full * BLOCK + F.size(F.filter(F.get(table, full), met))

    low, high = before(or_at=False), before(or_at=True)
    # The last of these ranges begins after the moment.
    spread = low + 1 + F.pmod(F.xxhash64("event_id"), high - low - 1).cast("int")
    place = F.coalesce(F.when(high - low > 1, spread).otherwise(high), F.lit(0)).cast("int")
    return df.repartitionById(len(bounds) + 1, place).sortWithinPartitions("event_ts", "event_id")


def append_new(batch: DataFrame, name: str) -> None:
    """Append the rows of ``batch`` whose ``event_id`` the table does not hold yet.

    If the table is bucketed by it, only the batch is shuffled, to the table's buckets.
    """
    new_rows(batch, name).write.mode("append").insertInto(name)


def new_rows(batch: DataFrame, name: str) -> DataFrame:
    target = batch.sparkSession.table(name)
    buckets = bucket_count(batch.sparkSession, name, "event_id")
    if buckets is not None:
        # Copies of an id are one row before they are sent.
        batch = first_per_event_id(batch).repartition(buckets, "event_id")
        # Not an anti join, which the optimizer would move below the shuffle, to another number of partitions.
        known = target.select(F.col("event_id").alias("_known"))
        found = batch.join(known, F.col("event_id") == F.col("_known"), "left")
        return found.filter(F.col("_known").isNull()).select(*target.columns)
    return rows_to_insert(batch, target).select(*target.columns)


def load(spark: SparkSession, query: str) -> DataFrame:
    return spark.sql(query)


def save_predictions(predictions: DataFrame, path: str) -> None:
    predictions.select("event_id", "predicted_completion_probability").write.mode("overwrite").parquet(path)

