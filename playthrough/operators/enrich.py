"""Events joined with the user and content dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame

from playthrough.operators.keysplits import KeySplits, join_dimension
from playthrough.schemas import ENRICHED_COLUMNS


def enriched_table(
    cleaned: DataFrame,
    users: DataFrame,
    content: DataFrame,
    user_splits: KeySplits | None = None,
    content_splits: KeySplits | None = None,
) -> DataFrame:
    """Inner joins: events of unknown users or titles are dropped."""
    joined = join_dimension(cleaned, content, "content_id", content_splits)
    return join_dimension(joined, users, "user_id", user_splits).select(*ENRICHED_COLUMNS)
