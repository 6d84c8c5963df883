"""Exact duplicates: group by a 128-bit digest, compare the bytes inside each group.

Grouping runs on (digest, text): rows of one digest with different bytes never share a class. Classes are
combined before the shuffle, so a text that a third of all rows hold leaves each task as one row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playthrough.llm.common import text_or_empty


def content_digest(text: Column) -> Column:
    """128 bits."""
    return F.unhex(F.md5(text))


def duplicate_report(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: str = "smallest",
    digest: Callable[[Column], Column] = content_digest,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    A null text counts as empty. Rows without an id belong to their group and stay only where no copy has
    an id (keep_id is then null). Rows that repeat id and text are one document and share ``kept``. Other columns are ignored. An empty table
    gives an empty result.
    """
    best = {"smallest": F.min, "largest": F.max}[keep]
    read = docs.select(F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    keyed = read.withColumn("digest", digest(F.col("text")))
    classes = (
        keyed.groupBy("digest", "text")
        .agg(best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("digest", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    # Only digests travel with the documents. The join's two sides are plain exchanges: a large group is split.
    members = keyed.select("doc_id", "digest", F.sha2("text", 256).alias("text_sha256"))
    return members.join(classes, ["digest", "text_sha256"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "smallest"
) -> DataFrame:
    """The documents with one row per text, all columns kept.

    Each task first reduces its own rows to one per text (the planner limits a ranked group before the
    shuffle). Rows without an id go before others; of rows that repeat an id, the first by all other columns stays.
    """
    wanted = F.col(id_column).asc_nulls_last() if keep == "smallest" else F.col(id_column).desc_nulls_last()
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in (id_column, text_column)]
    text = text_or_empty(text_column)
    keyed = docs.withColumn("__digest", content_digest(text)).withColumn("__bytes", text)
    in_group = Window.partitionBy("__digest", "__bytes").orderBy(wanted, *rest)
    ranked = keyed.withColumn("__rank", F.row_number().over(in_group)).filter(F.col("__rank") == 1)
    return ranked.drop("__digest", "__bytes", "__rank")
