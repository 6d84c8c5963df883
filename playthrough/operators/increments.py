"""History in parts: what the events so far leave for those to come.

``keyed_history`` looks back over all events of a key. For new events only, that is not needed: sums over all earlier
events and the latest values are a row per key, and a frame of ``span`` ms needs the events of that time. ``carry``
makes both at a moment, from the new events and the carry before it, so a run over a day's events reads them, the rows
of the keys, and the last ``span`` ms. ``history_since`` gives the same rows as ``keyed_history`` over all events, as
long as events come in order of time: what arrives with a time before the moment of a carry is not in it.

Only what lies before an event can be carried. Totals over all events of a key also change for events of the past.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playthrough.operators.history import keyed_history
from playthrough.operators.keysplits import KeySplits


@dataclass(frozen=True)
class History:
    """Which history of which key is asked for; as in ``keyed_history``."""

    keys: tuple[str, ...]
    prior: Mapping[str, Column]
    recent: Mapping[str, Column]
    lags: Mapping[str, Column]
    span: int = 0

    def names(self) -> dict[str, Column]:
        return {**self.prior, **self.recent, **self.lags}


@dataclass(frozen=True)
class Carry:
    """What events before ``until`` leave: a row per key with sums and latest values, and the events of the last span."""

    until: int
    per_key: DataFrame
    events: DataFrame

    def save(self, path: str) -> Carry:
        """Store it, and go on from the files."""
        self.per_key.write.parquet(f"{path}/per_key")
        self.events.write.parquet(f"{path}/events")
        return load(self.per_key.sparkSession, path, self.until)


def load(spark: SparkSession, path: str, until: int) -> Carry:
    return Carry(until, spark.read.parquet(f"{path}/per_key"), spark.read.parquet(f"{path}/events"))


def carry(new: DataFrame, until: int, history: History, before: Carry | None = None) -> Carry:
    """What the carry before and the new events before ``until`` leave.

    The latest value of a key goes with its position, so that parts are combined by an aggregate like the sums.
    """
    keys = list(history.keys)
    rows = new.filter(F.col("event_ts") < until)
    at = F.struct("event_ts", "event_id")
    sums = {n: F.coalesce(c, F.lit(0)) for n, c in history.prior.items()}
    latest = {n: F.when(c.isNotNull(), F.struct(at.alias("at"), c.alias("value"))) for n, c in history.lags.items()}
    narrow = rows.select(*keys, *[c.alias(n) for n, c in {**sums, **latest}.items()])
    if before is not None:
        narrow = narrow.unionByName(before.per_key)
    per_key = narrow.groupBy(*keys).agg(
        *[F.sum(n).alias(n) for n in sums], *[F.max_by(F.col(n), F.col(f"{n}.at")).alias(n) for n in latest]
    ) if sums or latest else narrow.distinct()
    # An event may look back span from ``until`` on.
    events = rows.select(*keys, "event_ts", "event_id", *[c.alias(n) for n, c in history.recent.items()])
    if before is not None:
        events = events.unionByName(before.events)
    return Carry(until, per_key, events.filter(F.col("event_ts") >= until - history.span) if history.recent else events.limit(0))


def history_since(new: DataFrame, history: History, before: Carry | None, splits: KeySplits | None = None) -> DataFrame:
    """``new`` plus one column per entry, as ``keyed_history`` over all events has them.

    The carried rows stand among the new events: a key's sums and latest values as one event just before the carry's
    moment, the events of the last span at their own time.
    """
    keys = list(history.keys)
    names = {n: f"_value_{n}" for n in history.names()}
    rows = new.withColumns({names[n]: c for n, c in history.names().items()}).withColumn("_is_new", F.lit(True))
    if before is not None:
        of_key = before.per_key.select(
            *keys,
            F.lit(before.until - 1).cast("bigint").alias("event_ts"),
            F.lit("").alias("event_id"),
            *[F.col(n).alias(names[n]) for n in history.prior],
            *[F.col(f"{n}.value").alias(names[n]) for n in history.lags],
        )
        of_events = before.events.select(*keys, "event_ts", "event_id", *[F.col(n).alias(names[n]) for n in history.recent])
        rows = rows.unionByName(of_key, allowMissingColumns=True).unionByName(of_events, allowMissingColumns=True)
    found = keyed_history(
        rows,
        keys,
        prior={n: F.col(names[n]) for n in history.prior},
        recent={n: F.col(names[n]) for n in history.recent},
        lags={n: F.col(names[n]) for n in history.lags},
        span=history.span if history.recent else None,
        splits=splits,
    )
    return found.filter("_is_new").select(*new.columns, *history.names())
