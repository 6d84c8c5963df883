"""The operators over whole tables, as registered queries, and SQL to check them against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playthrough.llm import (
    cap_filters,
    centroids,
    exact_dedup,
    language_model,
    mixing,
    ngram_join,
    packing,
    pii,
    quality,
    secrets,
    sharding,
    spelling,
    url_reputation,
)
from playthrough.llm.common import table
from playthrough.llm.sql import SQL  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_ngram_join(spark, sf_dir):
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_quality(spark, sf_dir):
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", "quality"))


@query
def op3_secrets(spark, sf_dir):
    return secrets.digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op4_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), word_tokenizer())


@query
def op5_sharding(spark, sf_dir):
    return sharding.balanced_shards(table(spark, sf_dir, "documents"))


@query
def op6_personal_data(spark, sf_dir):
    return pii.digest(pii.find_personal_data(table(spark, sf_dir, "documents")))


@query
def op7_url_filter(spark, sf_dir):
    """A page is labelled where its id has a quality label."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    judged = url_reputation.judge(table(spark, sf_dir, "pages"), labels)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query
def op8_embedding_near_dedup(spark, sf_dir):
    return cap_filters.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op9_exact_dedup(spark, sf_dir):
    return exact_dedup.duplicate_report(table(spark, sf_dir, "documents"), keep="largest")


@query
def op10_mixing(spark, sf_dir):
    return mixing.mix_report(table(spark, sf_dir, "documents"))


@query
def op11_centroid_clustering(spark, sf_dir):
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


@query
def op12_language_model(spark, sf_dir):
    return language_model.score(table(spark, sf_dir, "documents"))


@query
def op13_spelling_variants(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))
