"""Event, user and title tables derived from the generic test tables.

The generic ``events`` have neither titles nor devices, and about one event per user every half
day. Six-day blocks are compressed fifty-fold and set fifteen days apart on a one-minute grid,
which yields sessions, ties, gaps of exactly 30 minutes and distances of exactly 30 days. Some rows
are made invalid and some ids are repeated, for the cleaner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playthrough.functions.scalar import int_div, local_micros
from playthrough.schemas import CONTENT, EVENTS, USERS

START_MS = 1704067200000  # 2024-01-01


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = read(spark, sf_dir, "events")
    i = F.col("event_id")
    t = int_div(local_micros(F.col("ts")), F.lit(1000)) - START_MS
    k = F.get_json_object("props", "$.k").cast("int")
    ts = START_MS + int_div(t, F.lit(518400000)) * 1296000000 + int_div(t % 518400000, F.lit(3000000)) * 60000
    kind = (
        F.when(F.col("event_type") == "view", "play")
        .when(F.col("event_type") == "click", "pause")
        .when(F.col("event_type") == "purchase", "complete")
        .when(F.col("event_type") == "signup", "stop")
        .when(i % 2 == 0, "seek")
        .otherwise("error")
    )
    device = (
        F.when(i % 53 == 0, None)
        .when(i % 59 == 0, "")
        .when(i % 4 == 0, "mobile")
        .when(i % 4 == 1, "tv")
        .when(i % 4 == 2, "web")
        .otherwise("tablet")
    )
    position = F.when(i % 97 == 0, -1).otherwise(F.floor(F.col("value") * 60).cast("int"))
    row = {
        "event_id": i.cast("string"),
        "event_ts": ts,
        "user_id": F.col("user_id").cast("string"),
        "content_id": (k % 5).cast("string"),
        "event_type": kind,
        "playback_position": position,
        "device": device,
    }
    once, again = (
        F.struct(*[v.alias(c) for c, v in {**row, "event_ts": ts + delay}.items()]) for delay in (0, 60000)
    )
    # The copies come out of a generator: the source is scanned once, and filters on these columns do
    # not evaluate the expressions above again.
    rows = src.select(F.inline(F.when(i % 50 == 0, F.array(once, again)).otherwise(F.array(once))))
    return rows.select(*EVENTS.fieldNames())


def users_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    signup = F.date_add(F.lit("2023-01-01").cast("date"), ((key * 7) % 700).cast("int"))
    return read(spark, sf_dir, "customer").select(
        key.cast("string").alias("user_id"),
        F.concat(F.lit("user"), key.cast("string"), F.lit("@example.com")).alias("email"),
        F.col("c_mktsegment").alias("plan_tier"),
        signup.cast("timestamp_ntz").alias("signup_date"),
    ).select(*USERS.fieldNames())


def content_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    rating = F.element_at(F.array(*map(F.lit, ["G", "PG", "PG-13", "R"])), (key % 4 + 1).cast("int"))
    return read(spark, sf_dir, "part").select(
        key.cast("string").alias("content_id"),
        F.col("p_type").alias("genre"),
        (F.col("p_size") * 120).cast("int").alias("runtime"),
        (1990 + key % 35).cast("int").alias("release_year"),
        rating.alias("maturity_rating"),
    ).select(*CONTENT.fieldNames())
