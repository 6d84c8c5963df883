"""Mix sources to target weights by repetition.

Words per source are added up, every source gets a target, and target / words is the source's repetition
rate: each document is taken floor(rate) times, and once more with the probability of the fraction, drawn
from a hash of its id.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playthrough.llm.common import ASCII_SPACE, store

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2
SEED = "mix"


def word_count(text: Column) -> Column:
    """Number of runs of other characters than ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{ASCII_SPACE}]+")), F.lit(0)).cast("long")


def _positions(sources: DataFrame) -> DataFrame:
    """Position of each source by code point, null last. Sorted by ranges, so no task holds all sources."""
    in_order = F.col("source").asc_nulls_last()
    parts = store(sources.sort(in_order).withColumn("part", F.spark_partition_id()), "sources")
    counts = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(in_order))
    numbered = parts.withColumn("inside", inside).join(offsets, "part")
    return numbered.select("source", "source_size", (F.col("inside") + F.col("offset") - 1).alias("position"))


def source_targets(
    sized: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most_repeats: int = MOST_REPEATS,
) -> DataFrame:
    """source, source_size, target, rate from rows (source, size).

    The level (words per unit of weight) rises until no open source passes its cap; each round is one
    aggregate over the sources, of which the driver sees two sums.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    position = F.col("position")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (position % len(weights) + 1).cast("int"))
    sources = store(_positions(store(sums, "sums")).withColumn("weight", weight), "weights")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    cap = F.col("source_size") * most_repeats
    level = 0.0
    while True:
        reached = cap <= F.col("weight") * F.lit(level)
        capped, open_weight = sources.agg(
            F.coalesce(F.sum(F.when(reached, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~reached, F.col("weight"))), F.lit(0))
        ).first()
        if not open_weight:
            level = math.inf
            break
        higher = (share * total - capped) / open_weight
        if higher <= level:
            break
        level = higher
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(level)) if math.isfinite(level) else cap.cast("double")
    size = F.col("source_size")
    return store(
        sources.select("source", size, target.alias("target"))
        .withColumn("rate", F.when(size > 0, F.col("target") / size).otherwise(0.0)),
        "targets",
    )


def copies(rate: Column, key: Column, seed: str = SEED) -> Column:
    """floor(rate), and one more if the hash of the key, as a number in [0, 1), is below the fraction."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    draw = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(2**52)
    whole = F.floor(rate)
    return whole + F.when(draw < rate - whole, 1).otherwise(0)


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken.

    A null text has size 0; a null source is a source of its own, the last. Rows that repeat an id are drawn
    alike. A table without words gets targets of 0. Columns other than doc_id, source and text are ignored.
    """
    sized = store(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    targets = source_targets(sized, **options).withColumnRenamed("source", "of_source")
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("of_source")))
    taken = (F.col("size") * copies(F.col("rate"), F.col("doc_id"))).cast("long")
    return joined.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The documents themselves, each as many times as the mix takes it; all columns kept."""
    sized = store(docs.select("source", word_count(F.col("text")).alias("size")), "sizes")
    rates = source_targets(sized, **options).select(F.col("source").alias("__source"), F.col("rate").alias("__rate"))
    joined = docs.join(rates, F.col("source").eqNullSafe(F.col("__source")))
    times = copies(F.col("__rate"), F.col("doc_id")).cast("int")
    repeated = joined.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), times)))
    return repeated.drop("__source", "__rate", "__copy")
