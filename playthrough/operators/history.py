"""What happened to the same key before an event.

``keyed_history`` computes, for every row, aggregates over earlier rows of its key. Frames are RANGE
frames over ``event_ts``, so rows with the same timestamp never see each other:

* ``prior``  sum over all rows with an earlier timestamp
* ``recent`` sum over rows at most ``span`` ms earlier (exactly ``span`` is included)
* ``lags``   latest non-null value on a preceding row in ``(event_ts, event_id)`` order
* ``totals`` sum over all rows of the key, later ones included

Values must be integers or decimals: their sums are exact, so a result does not depend on how the
rows were partitioned. Every frame grows from the start of the key. A sliding sum is the
difference of two growing ones, as a sliding frame would add up its whole content for every row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playthrough.operators import keysplits as ks
from playthrough.sources.checkpoint import stored

AT, EXPIRY, PAYLOAD = "_at", "_expiry", "_payload"


def keyed_history(
    df: DataFrame,
    keys: Sequence[str],
    *,
    prior: Mapping[str, Column] | None = None,
    recent: Mapping[str, Column] | None = None,
    span: int | None = None,
    lags: Mapping[str, Column] | None = None,
    totals: Mapping[str, Column] | None = None,
    splits: ks.KeySplits | None = None,
) -> DataFrame:
    """``df`` plus one column per entry; no row is added, dropped or merged."""
    prior, recent, lags, totals = prior or {}, recent or {}, lags or {}, totals or {}
    if recent and span is None:
        raise ValueError("recent needs a span")
    run = _chunked if splits is not None and splits.any_hot else _whole
    return run(df, list(keys), prior, recent, span, lags, totals, splits)


def _or_zero(total: Column) -> Column:
    return F.coalesce(total, F.lit(0))


def _whole(df, keys, prior, recent, span, lags, totals, _splits):
    """One window partition per key."""
    part = Window.partitionBy(*keys)
    preceding = part.orderBy("event_ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    by_time = part.orderBy("event_ts")
    earlier = by_time.rangeBetween(Window.unboundedPreceding, -1)
    # The finer order first: it also serves the frames that follow, so there is one sort.
    # coalesce: over a bare column the optimizer would move this window below others, and sort more.
    latest = {name: F.last(F.coalesce(value), ignorenulls=True) for name, value in lags.items()}
    df = df.withColumns({name: value.over(preceding) for name, value in latest.items()})
    frames = {name: _or_zero(F.sum(value).over(earlier)) for name, value in prior.items()}
    if recent:
        expired = by_time.rangeBetween(Window.unboundedPreceding, -span - 1)
        for name, value in recent.items():
            frames[name] = _or_zero(F.sum(value).over(earlier)) - _or_zero(F.sum(value).over(expired))
    df = df.withColumns(frames)
    return df.withColumns({name: _or_zero(F.sum(value).over(part)) for name, value in totals.items()})


def _chunked(df, keys, prior, recent, span, lags, totals, splits):
    """Windows inside chunks of a key, plus what the key's earlier chunks carry over.

    In a hot key an event leaves the sliding frame by a row of its own, ``span`` later and with
    the opposite sign: chunks then only need the sum of what lies before them. The other keys
    have a single chunk and use the two growing frames.
    """
    payload = [c for c in df.columns if c not in (*keys, "event_ts", "event_id")]
    groups = {"p": prior, "r": recent, "l": lags, "t": totals}
    values = {(g, name): f"_{g}{i}" for g, found in groups.items() for i, name in enumerate(found)}
    found_here = [value.alias(values[g, name]) for g, found in groups.items() for name, value in found.items()]
    # In one column, which sorts, windows and joins copy as a whole.
    packed = [F.struct(*payload).alias(PAYLOAD)] if payload else []
    rows = df.select(*keys, "event_ts", "event_id", *packed, *found_here)

    if recent:
        last = splits.table.select(*splits.keys, ks.LAST_TS)
        stays = F.lit(False)
        leaves_in_time = F.col("event_ts") + span < F.col(ks.LAST_TS)  # null for keys that are not hot
        counts_once = [*([PAYLOAD] if payload else []), *[c for (g, _), c in values.items() if g != "r"]]
        rows = (
            rows.join(last, list(splits.keys), "left")
            .withColumn(EXPIRY, F.explode(F.when(leaves_in_time, F.array(stays, ~stays)).otherwise(F.array(stays))))
            .drop(ks.LAST_TS)
            .withColumns({c: F.when(~F.col(EXPIRY), F.col(c)) for c in counts_once})
            .withColumns({c: F.when(F.col(EXPIRY), -F.col(c)).otherwise(F.col(c)) for (g, _), c in values.items() if g == "r"})
            .withColumn(AT, F.col("event_ts") + F.when(F.col(EXPIRY), span).otherwise(0))
        )
    else:
        rows = rows.withColumns({EXPIRY: F.lit(False), AT: F.col("event_ts")})
    # Read twice below, by the carry-over, which takes a few columns only, and by the windows.
    rows = stored(splits.assign(rows.drop("event_ts"), F.col(AT), F.col("event_id")).drop(ks.LAST_TS))

    sums = {c: F.col(c) for (g, _), c in values.items() if g != "l"}
    latest = {c: F.col(c) for (g, _), c in values.items() if g == "l"}

    # One row per chunk and sub-chunk of a hot key.
    chunk_key = [*keys, ks.CHUNK, ks.SUB]
    totals_of = [F.sum(v).alias(c) for c, v in sums.items()]
    lasts_of = [F.max_by(v, F.when(v.isNotNull(), F.struct(AT, "event_id"))).alias(c) for c, v in latest.items()]
    per_chunk = rows.filter(ks.HOT).groupBy(*chunk_key).agg(F.count(F.lit(1)).alias("_n"), *totals_of, *lasts_of)
    carry_cols = {}
    for (g, _), c in values.items():
        if g in "pr":
            carry_cols[f"{c}_c"] = F.sum(c).over(ks.before_chunk(keys))
        elif g == "t":
            carry_cols[f"{c}_c"] = F.sum(c).over(Window.partitionBy(*keys))
        else:
            carry_cols[f"{c}_c"] = F.last(c, ignorenulls=True).over(ks.before_sub(keys))
    carry = per_chunk.select(*chunk_key, *[v.alias(c) for c, v in carry_cols.items()])

    part = Window.partitionBy(*chunk_key)
    by_time = part.orderBy(AT)
    earlier = by_time.rangeBetween(Window.unboundedPreceding, -1)
    before = part.orderBy(AT, "event_id").rowsBetween(Window.unboundedPreceding, -1)
    # coalesce: over a bare column the optimizer would move this window below others, and sort more.
    lasts = {f"{c}_w": F.last(F.coalesce(v), ignorenulls=True).over(before) for c, v in latest.items()}
    out = splits.cluster(rows).withColumns(lasts)
    frames = {}
    for (g, _), c in values.items():
        if g == "p":
            frames[f"{c}_w"] = F.sum(c).over(earlier)
        elif g == "r":
            expired = by_time.rangeBetween(Window.unboundedPreceding, -span - 1)
            gone = F.when(F.col(ks.HOT), 0).otherwise(_or_zero(F.sum(c).over(expired)))
            frames[f"{c}_w"] = _or_zero(F.sum(c).over(earlier)) - gone
    out = out.withColumns(frames)
    out = out.withColumns({f"{c}_w": F.sum(c).over(part) for (g, _), c in values.items() if g == "t"})
    out = out.join(carry, chunk_key, "left").filter(~F.col(EXPIRY))

    results = {}
    for (g, name), c in values.items():
        inside, carried = F.col(f"{c}_w"), F.col(f"{c}_c")
        if g == "l":
            results[name] = F.coalesce(inside, carried)
        elif g == "t":
            results[name] = _or_zero(F.when(F.col(ks.HOT), carried).otherwise(inside))
        else:
            results[name] = _or_zero(inside) + _or_zero(carried)
    back = {"event_ts": F.col(AT).alias("event_ts"), **{c: F.col(PAYLOAD)[c].alias(c) for c in payload}}
    return out.select(*[back.get(c, c) for c in df.columns], *[value.alias(name) for name, value in results.items()])
