"""Column expressions shared by the operators.

Calendar fields are taken by integer arithmetic on epoch milliseconds and from DATE values, so
they are UTC whatever ``spark.sql.session.timeZone`` says.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_MS = 60 * 60 * 1000
DAY_MS = 24 * HOUR_MS
EPOCH_WEEKDAY = 4  # 1970-01-01 was a Thursday; Sunday is 0
RATIO_SCALE = 1_000_000_000

# Fixed values.
SESSION_GAP_MS = 30 * 60 * 1000
HISTORY_MS = 30 * DAY_MS
NEAR_END = 0.95
SHORT_BELOW = 1200
MEDIUM_UP_TO = 3600


def int_div(value: Column, divisor: Column) -> Column:
    """64-bit integer division, truncating; never goes through double."""
    return F.call_function("div", value, divisor)


def floor_div(value: Column, divisor: int) -> Column:
    """Integer floor division, also for negative values."""
    return int_div(value - F.pmod(value, F.lit(divisor)), F.lit(divisor))


def epoch_day(ts_ms: Column) -> Column:
    return floor_div(ts_ms, DAY_MS).cast("int")


def utc_date(ts_ms: Column) -> Column:
    return F.date_from_unix_date(epoch_day(ts_ms))


def hour_of_day(ts_ms: Column) -> Column:
    return int_div(F.pmod(ts_ms, F.lit(DAY_MS)), F.lit(HOUR_MS)).cast("int")


def day_of_week(ts_ms: Column) -> Column:
    """Sunday = 0 … Saturday = 6."""
    return F.pmod(epoch_day(ts_ms) + EPOCH_WEEKDAY, F.lit(7)).cast("int")


def week_of_year(ts_ms: Column) -> Column:
    """ISO week."""
    return F.weekofyear(utc_date(ts_ms))


def month_of_year(ts_ms: Column) -> Column:
    return F.month(utc_date(ts_ms))


def year(ts_ms: Column) -> Column:
    return F.year(utc_date(ts_ms))


def local_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 00:00 of a zone-less timestamp's own wall clock."""
    since = ts.cast("timestamp_ntz") - F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    return int_div(since, F.expr("INTERVAL '0.000001' SECOND"))


def days_between(ts_ms: Column, since: Column) -> Column:
    """Whole days from a zone-less timestamp to an epoch-ms instant; negative if it lies later."""
    return floor_div(ts_ms * 1000 - local_micros(since), DAY_MS * 1000)


def position_ratio(position: Column, runtime: Column) -> Column:
    """position / runtime in double precision; null, not an error, for a zero runtime."""
    return F.try_divide(position.cast("double"), runtime.cast("double"))


def scaled_ratio(position: Column, runtime: Column) -> Column:
    """position / runtime as an integer number of 1e-9 units, rounded half up.

    Sums of these are exact, hence the same for every partitioning of the rows and every order of
    summation. Decimal because a hot key's sum may leave the 64-bit range.
    """
    divisor = F.when(runtime != 0, runtime.cast("bigint"))
    half = int_div(divisor, F.lit(2))
    return int_div(position.cast("bigint") * RATIO_SCALE + half, divisor).cast("decimal(20,0)")


def mean_of_scaled(total: Column, count: Column) -> Column:
    """Mean of ``scaled_ratio`` values; null over no rows."""
    return F.when(count > 0, total.cast("double") / RATIO_SCALE / count)


def rate(hits: Column, count: Column) -> Column:
    """hits / count, and 0 (not null) over no rows."""
    return F.when(count > 0, hits.cast("double") / count).otherwise(F.lit(0.0))


def stopped_near_end(event_type: Column, position: Column, runtime: Column) -> Column:
    at_end = (event_type == "stop") & (position_ratio(position, runtime) >= NEAR_END)
    return F.when(at_end, 1).otherwise(0)


def length_category(runtime: Column) -> Column:
    return (
        F.when(runtime < SHORT_BELOW, "short")
        .when(runtime <= MEDIUM_UP_TO, "medium")
        .otherwise("long")
    )


def is_completion(completed: Column, near_end: Column, distinct_types: Column) -> Column:
    done = (completed == 1) | ((near_end == 1) & (distinct_types > 1))
    return F.when(done, 1).otherwise(0)
