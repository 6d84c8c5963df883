"""What the operators share: scratch tables, numbering without a single task, literals."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playthrough.sources.checkpoint import remove, shared_folder  # noqa: F401
from playthrough.sources.code import ship_code  # noqa: F401

#: Rows of a group that one task numbers, at most.
ROWS_PER_BUCKET = 1_000_000
#: Buckets of a numbered group, at least, so that small data are dealt out too.
LEAST_BUCKETS = 64
ASCII_SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share."""
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to shared storage and go on from the files: a lost executor costs no recomputation."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def buckets_for(rows: int) -> int:
    return max(LEAST_BUCKETS, -(-rows // ROWS_PER_BUCKET))


def hash_bucket(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("bucket")), F.lit(n)).cast("int")


def running(df: DataFrame, groups: Sequence[str], amount: Column, bucket: Column, order: Sequence[Column], name: str):
    """Add ``name``: the sum of ``amount`` over the rows of the group that come before.

    Rows come by ``bucket``, then ``order``. A task holds one bucket of a group: totals per bucket are
    added up first, and each bucket starts from its offset. ``df`` is read twice, so it should be stored.
    """
    rows = df.withColumn("__bucket", bucket).withColumn("__amount", amount.cast("long"))
    keys = [*groups, "__bucket"]
    totals = rows.groupBy(*keys).agg(F.sum("__amount").alias("__total"))
    before = Window.partitionBy(*groups).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"__of_{k}") for k in keys], F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__offset")
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__inside", F.coalesce(F.sum("__amount").over(inside), F.lit(0)))
    match = [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys]
    joined = rows.join(offsets, match)
    return joined.withColumn(name, F.col("__inside") + F.col("__offset")).drop(
        "__bucket", "__amount", "__inside", "__offset", *[f"__of_{k}" for k in keys]
    )


def long_array(values: Sequence[int]) -> Column:
    """A small array of numbers as a literal."""
    return F.array(*[F.lit(int(v)).cast("long") for v in values])
