"""A corpus from raw documents: keep what is good, once, mixed by source, in sequences of equal length."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playthrough.llm import exact_dedup, mixing, ngram_join, packing, quality
from playthrough.llm.common import store, table, text_or_empty
from playthrough.llm.queries import word_tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of the learning part, does not reject."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return quality.accepted(docs, labels).select(COLUMNS)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per text: the one with the largest id."""
    return exact_dedup.drop_duplicates(docs, keep="largest").select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked texts: the one with the smallest id.

    Rows are told apart by id and text, as an id may repeat with other texts. Rows without an id stay.
    """
    key = F.when(F.col("doc_id").isNotNull(), F.xxhash64(text_or_empty()))
    found = ngram_join.near_duplicates(docs.select(key.alias("doc_id"), "text")).filter("doc_id is not null")
    groups = found.select(F.col("doc_id").alias("__key"), F.col("component_id").alias("__group")).distinct()
    rows = docs.select(F.col("doc_id").alias("__id"), key.alias("__key")).filter("__key is not null")
    rows = store(rows.join(groups, "__key"), "groups")
    stays = rows.groupBy("__group").agg(F.min(F.struct("__id", "__key")).alias("__stays"))
    dropped = rows.join(stays, "__group").filter(F.struct("__id", "__key") != F.col("__stays"))
    dropped = store(dropped.select("__id", F.col("__key").alias("__dropped")).distinct(), "dropped")
    same = (F.col("doc_id") == F.col("__id")) & (F.col("__key") == F.col("__dropped"))
    return docs.withColumn("__key", key).join(dropped, same, "left_anti").select(COLUMNS)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as its source's rate asks for, 0 times included."""
    return mixing.mix(docs).select(COLUMNS)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, each in its place of a sequence."""
    return packing.pack(docs, word_tokenizer())


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", exact_duplicates),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing to target weights", mixed_sources),
    ("packing", packed_sequences),
]

#: Fitted models and tokenizers are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
