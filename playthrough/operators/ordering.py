"""Positions in a global order, without putting all rows through one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from playthrough.sources.checkpoint import materialize

PIVOTS = 64
THINNED_TO = 20_000  # rows the pivots are picked from
SORT_AT_MOST = 100_000  # rows sorted in one place at the end of a selection


def row_at(
    df: DataFrame, order: Sequence[str], k: int, n_rows: int | None = None, sort_at_most: int | None = None
) -> Row | None:
    """The ``k``-th row (from 0) of ``df`` ordered by ``order``, whose values must be unique.

    Repeatedly counts the rows between a few sampled pivots and goes on with the interval holding
    the ``k``-th: a few scans of the ordering columns, no sort of the table.
    """
    rows = df.select(*order)
    here = F.struct(*order)
    n = rows.count() if n_rows is None else n_rows
    while n > (sort_at_most or SORT_AT_MOST):
        # Thin out by one hash, then keep one row per slot of another.
        thin = rows.filter(F.pmod(F.xxhash64(F.lit("thin"), *order), F.lit(max(1, n // THINNED_TO))) == 0)
        slot = F.pmod(F.xxhash64(*order), F.lit(PIVOTS))
        picked = thin.groupBy(slot.alias("_slot")).agg(F.max_by(here, F.xxhash64(F.lit(n), *order)).alias("_p"))
        pivots = sorted(tuple(r["_p"]) for r in picked.collect())  # PIVOTS rows
        points = [F.struct(*[F.lit(v).alias(c) for c, v in zip(order, p)]) for p in pivots]
        interval = _interval(points, here)
        counts = dict(rows.groupBy(interval.alias("_i")).count().collect())  # PIVOTS + 1 rows
        i = 0
        while k >= counts.get(i, 0) and i < PIVOTS:
            k -= counts.get(i, 0)
            i += 1
        if counts.get(i, 0) == n:
            raise ValueError(f"values of {list(order)} are not unique")
        # Two plain comparisons: the scans that follow look at all rows again, and compare no row with all pivots.
        if i > 0:
            rows = rows.filter(points[i - 1] <= here)
        if i < len(points):
            rows = rows.filter(here < points[i])
        n = counts.get(i, 0)
    found = rows.orderBy(*order).offset(k).limit(1).collect()
    return found[0] if found else None


def _interval(points: Sequence[Column], here: Column, first: int = 0) -> Column:
    """How many of the ascending points are at most ``here``, found by halving."""
    if not points:
        return F.lit(first)
    middle = len(points) // 2
    below = _interval(points[:middle], here, first)
    return F.when(here < points[middle], below).otherwise(_interval(points[middle + 1 :], here, first + middle + 1))


def is_before(row: Row | None, order: Sequence[str]) -> Column:
    """Whether a row lies before ``row``; all do when it is None."""
    if row is None:
        return F.lit(True)
    return F.struct(*order) < F.struct(*[F.lit(row[c]).alias(c) for c in order])


def chronological_split(df: DataFrame, test_size: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """The oldest rows for training, the newest for testing; exact, ties go by event id."""
    before = is_before(chronological_cut(df, test_size), ["event_ts", "event_id"])
    return df.filter(before), df.filter(~before)


def chronological_cut(df: DataFrame, test_size: float = 0.2, sort_at_most: int | None = None) -> Row | None:
    """The first test row."""
    n = df.count()
    return row_at(df, ["event_ts", "event_id"], int(n * (1 - test_size)), n, sort_at_most)


def next_oldest(
    df: DataFrame, after: Row | None, k: int, order: Sequence[str] = ("event_ts", "event_id"), sort_at_most: int | None = None
) -> tuple[DataFrame, Row | None]:
    """The rows of the ``k`` oldest keys from ``after`` on, and the key that the next call goes on from; None at the end.

    Rows of one key stay together. Rows with a null in the key have no place and are left out. Counting between pivots
    finds the cut, so no task holds the rows, as a top-k would have it.
    """
    order = list(order)
    here = F.struct(*order)

    def bound(row: Row) -> Column:
        return F.struct(*[F.lit(row[c]).cast(df.schema[c].dataType).alias(c) for c in order])

    rows = df.dropna(subset=order)
    if after is not None:
        rows = rows.filter(here >= bound(after))
    keys = materialize(rows.select(*order).distinct())
    n = keys.count()
    cut = row_at(keys, order, k, n, sort_at_most) if n > k else None
    return (rows if cut is None else rows.filter(here < bound(cut))), cut


def running_sums(
    df: DataFrame, order: str, sums: Mapping[str, str], totals: Mapping[str, str], ahead: Mapping[str, str]
) -> DataFrame:
    """Running totals over all rows in ascending order of one column, and values of the row after.

    ``sums`` maps new columns to the column to add up, up to and including the row; ``totals`` to one
    to add up over all rows; ``ahead`` to one to take from the next row. The rows are
    range-partitioned: each partition adds up by itself, and starts from the totals of those before.
    """
    ranged = df.repartitionByRange(order).withColumn("_range", F.spark_partition_id())
    ranged = materialize(ranged)  # the ranges come from a sample: fix them before using them twice
    first = F.min_by(F.struct(*set(ahead.values())), order)
    per_range = ranged.groupBy("_range").agg(
        *[F.sum(c).alias(f"_total_{name}") for name, c in {**sums, **totals}.items()], first.alias("_first")
    )
    # One row per partition.
    ranges = Window.orderBy("_range")
    earlier = ranges.rowsBetween(Window.unboundedPreceding, -1)
    carry = per_range.select(
        "_range",
        *[F.sum(f"_total_{n}").over(earlier).alias(f"_carry_{n}") for n in sums],
        *[F.sum(f"_total_{n}").over(Window.partitionBy()).alias(n) for n in totals],
        F.lead("_first").over(ranges).alias("_next"),
    )
    inside = Window.partitionBy("_range").orderBy(order)
    up_to_here = inside.rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.withColumns(
        {
            **{f"_in_{name}": F.sum(c).over(up_to_here) for name, c in sums.items()},
            **{f"_in_{name}": F.lead(F.struct(c)).over(inside) for name, c in ahead.items()},
        }
    ).join(F.broadcast(carry), "_range")
    results = [(F.col(f"_in_{n}") + F.coalesce(f"_carry_{n}", F.lit(0))).alias(n) for n in sums]
    results += [
        F.when(F.col(f"_in_{n}").isNotNull(), F.col(f"_in_{n}")[c]).otherwise(F.col("_next")[c]).alias(n)
        for n, c in ahead.items()
    ]
    return out.select(*df.columns, *totals, *results)
