"""Row cleaning: coercion, validation with a reason per rejected row, and one row per event id.

Everything but the final de-duplication is stateless column work, so the same functions run on a
stream.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playthrough.schemas import EVENT_COLUMNS

VALID_EVENT_TYPES = ["play", "pause", "stop", "complete", "seek"]  # fixed values, case-sensitive

MISSING, NOT_NUMERIC, BAD_TYPE, NEGATIVE = (
    "missing_field",
    "not_numeric",
    "invalid_event_type",
    "negative_position",
)
REQUIRED_TEXT = ["event_id", "user_id", "content_id", "event_type", "device"]
NUMERIC = {"event_ts": T.LongType(), "playback_position": T.IntegerType()}


def to_integer(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """Truncate toward zero; null where the value is no number or does not fit."""
    if source == target:
        return value
    if isinstance(source, T.StringType):
        # Plain integers keep all 64 bits, anything else goes through double.
        return F.coalesce(value.try_cast(target), value.try_cast("double").try_cast(target))
    if isinstance(source, T.IntegralType):
        return value.try_cast(target)
    return value.cast("double").try_cast(target)


def all_of(conditions: list[Column]) -> Column:
    return functools.reduce(operator.and_, conditions)


def rules(schema: T.StructType) -> list[tuple[str, Column]]:
    """Reason for rejection and the condition a valid row meets, in the order they are tested.

    Plain comparisons of single columns, so that a filter over them reaches the Parquet scan.
    """
    kind = {f.name: f.dataType for f in schema.fields}
    present = [F.col(name).isNotNull() & (F.col(name) != "") for name in REQUIRED_TEXT]
    present += [F.col(name).isNotNull() for name in NUMERIC]
    ts, position = (to_integer(F.col(name), kind[name], target) for name, target in NUMERIC.items())
    return [
        (MISSING, all_of(present)),
        (NOT_NUMERIC, ts.isNotNull() & position.isNotNull()),
        (BAD_TYPE, F.col("event_type").isin(VALID_EVENT_TYPES)),
        (NEGATIVE, position >= 0),
    ]


def _coerced(raw: DataFrame) -> list[Column]:
    return [
        to_integer(F.col(c), raw.schema[c].dataType, NUMERIC[c]).alias(c) if c in NUMERIC else F.col(c)
        for c in EVENT_COLUMNS
    ]


def with_reject_reason(raw: DataFrame) -> DataFrame:
    """The seven event columns, coerced, plus ``reject_reason`` (null for a valid row).

    The first rule that fails gives the reason.
    """
    failed = [F.when(~F.coalesce(valid, F.lit(False)), reason) for reason, valid in rules(raw.schema)]
    return raw.select(*_coerced(raw), F.coalesce(*failed).alias("reject_reason"))


def valid_events(raw: DataFrame) -> DataFrame:
    return raw.filter(all_of([valid for _, valid in rules(raw.schema)])).select(*_coerced(raw))


def rejected_events(raw: DataFrame) -> DataFrame:
    return with_reject_reason(raw).filter(F.col("reject_reason").isNotNull())


def reject_counts(raw: DataFrame) -> DataFrame:
    return rejected_events(raw).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_rows"))


def oldest_events(raw: DataFrame, max_rows: int) -> DataFrame:
    """The ``max_rows`` oldest rows (a top-k, not a sort of the table)."""
    return raw.orderBy(F.asc_nulls_last("event_ts"), "event_id").limit(max_rows)


def first_per_event_id(events: DataFrame) -> DataFrame:
    """One row per event id: the oldest.

    An aggregate rather than a row number, as it combines copies before the shuffle: an id with
    very many copies costs one row per map task.
    """
    rest = [c for c in EVENT_COLUMNS if c != "event_id"]
    first = events.groupBy("event_id").agg(F.min(F.struct(*rest)).alias("_first"))
    return first.select("event_id", *[F.col("_first")[c].alias(c) for c in rest])


def clean_events(raw: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Valid rows, one per event id; ``max_rows`` looks at the oldest rows only."""
    source = raw if max_rows is None else oldest_events(raw, max_rows)
    return first_per_event_id(valid_events(source))


def rows_to_insert(batch: DataFrame, target: DataFrame) -> DataFrame:
    """Rows of ``batch`` whose event id is new to ``target``, one per id."""
    return first_per_event_id(batch).join(target.select("event_id"), "event_id", "left_anti")
