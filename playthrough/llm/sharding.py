"""Shards of equal row counts that keep linked documents together: balanced label propagation.

Documents with equal text are linked. Every document starts in a shard by the hash of its id. Documents of one
group in the same hash cell move together (an atom). In each round the groups' atoms vote by their numbers,
an atom asks for the shard where most of its group is, and requests are granted in hash order while the
shard has room. At the end surplus rows, those without links first, fill what other shards lack, so that
counts differ by one at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playthrough.llm.common import buckets_for, hash_bucket, long_array, running, store, text_or_empty

SHARDS = 40
#: Hash cells per shard in which documents start: a group is cut into shards * CELLS atoms at most.
CELLS = 16
ROUNDS = 6
#: Share by which a shard may exceed its quota while labels move; the last step evens it out.
SLACK = 0.1
#: Steps in which requests for a shard are granted.
PRIORITIES = 1024


def _loads(rows: DataFrame, amount: Column, n_shards: int) -> list[int]:
    """Rows per shard; one number per shard comes to the driver."""
    found = dict(rows.groupBy("shard").agg(F.sum(amount)).collect())
    return [int(found.get(s) or 0) for s in range(n_shards)]


def _round(atoms: DataFrame, quotas: list[int], n_shards: int, number: int) -> tuple[DataFrame, bool]:
    loads = _loads(atoms, F.col("n"), n_shards)
    room = [max(0, int(q * (1 + SLACK)) + 1 - load) for q, load in zip(quotas, loads)]
    votes = atoms.groupBy("link", "shard").agg(F.sum("n").alias("votes"))
    has_room = F.element_at(long_array(room), F.col("shard") + 1) > 0
    # Of shards with equal votes a hash chooses, so that none is preferred.
    rank = F.struct(F.col("votes"), F.xxhash64("link", "shard").alias("tie"), F.col("shard"))
    best = votes.groupBy("link").agg(F.max(F.when(has_room, rank)).alias("best")).filter(F.col("best").isNotNull())
    asked = (
        atoms.join(votes, ["link", "shard"])
        .join(best, "link", "left")
        .withColumn("to", F.when(F.col("best") > rank, F.col("best.shard")))
        .withColumn("priority", F.pmod(F.xxhash64("link", "cell", F.lit(number)), F.lit(PRIORITIES)).cast("int"))
        .select("link", "cell", "n", "shard", "to", "priority")
    )
    asked = store(asked, "requests")
    # At most PRIORITIES rows per shard, and one limit per shard comes to the driver.
    steps = asked.filter("to is not null").groupBy("to", "priority").agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("to").orderBy("priority"))
    fits = steps.withColumn("upto", upto).filter(
        F.col("upto") <= F.element_at(long_array(room), F.col("to") + 1)
    )
    limits = dict(fits.groupBy("to").agg(F.max("priority")).collect())
    if not limits:
        return atoms, False
    limit = F.element_at(long_array([limits.get(s, -1) for s in range(n_shards)]), F.col("to") + 1)
    shard = F.when(F.col("priority") <= limit, F.col("to")).otherwise(F.col("shard"))
    return asked.select("link", "cell", "n", shard.alias("shard")), True


def propagate(atoms: DataFrame, quotas: list[int], rounds: int = ROUNDS) -> DataFrame:
    """Move atoms (link, cell, n, shard) towards the shard of most of their link's documents, within quotas."""
    for number in range(rounds):
        atoms, moved = _round(atoms, quotas, len(quotas), number)
        if not moved:
            break
    return atoms


def balanced_shards(
    docs: DataFrame, n_shards: int = SHARDS, cells: int = CELLS, rounds: int = ROUNDS
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size is the UTF-8 length of the text plus 16. The law is ``rows``: counts of shards differ by one at most,
    slots run from 0 without a gap. A null text counts as empty. Rows with a null or repeated id are rows of their own. Columns other than doc_id and
    text are ignored; an empty table gives an empty result.
    """
    text = text_or_empty()
    cell = F.pmod(F.xxhash64("doc_id", F.lit("cell")), F.lit(n_shards * cells)).cast("int")
    base = store(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 16).cast("long").alias("size"),
            F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
            F.unhex(F.md5(text)).alias("link"),
            cell.alias("cell"),
        ),
        "documents",
    )
    total = base.count()
    quotas = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    start = F.pmod("cell", F.lit(n_shards)).cast("int")
    counted = base.groupBy("link", "cell").agg(F.count(F.lit(1)).alias("n"))
    linked = counted.groupBy("link").agg(F.sum("n").alias("members")).filter("members > 1").select("link")
    atoms = store(counted.join(linked, "link", "left_semi").withColumn("shard", start), "atoms")
    atoms = propagate(atoms, quotas, rounds).select("link", "cell", F.col("shard").alias("moved"))

    placed = base.join(atoms, ["link", "cell"], "left").select(
        "doc_id",
        "size",
        "text_crc32",
        F.coalesce("moved", start).alias("shard"),
        F.col("moved").isNull().cast("int").alias("single"),
    )
    placed = store(placed, "placed")
    n_buckets = buckets_for(total // max(1, n_shards))
    bucket = F.col("single") * n_buckets + hash_bucket(F.col("doc_id"), n_buckets)
    ranked = running(placed, ["shard"], F.lit(1), bucket, ["doc_id", "size", "text_crc32"], "place")

    loads = _loads(placed, F.lit(1), n_shards)
    surplus = [max(0, load - q) for load, q in zip(loads, quotas)]
    lacking = [max(0, q - load) for load, q in zip(loads, quotas)]
    starts = long_array([sum(surplus[:s]) for s in range(n_shards)])
    filled = [sum(lacking[: s + 1]) for s in range(n_shards)]
    quota = F.element_at(long_array(quotas), F.col("shard") + 1)
    over = F.when(F.col("place") >= quota, F.element_at(starts, F.col("shard") + 1) + F.col("place") - quota)
    ranked = ranked.withColumn("over", over)
    target = F.size(F.filter(long_array(filled), lambda end: end <= F.col("over")))
    ranked = ranked.withColumn("target", F.when(F.col("over").isNotNull(), target))
    # A row that fills shard t comes after the rows that t has already.
    shift = long_array([load - (end - lack) for load, end, lack in zip(loads, filled, lacking)])
    slot = F.when(F.col("over").isNull(), F.col("place")).otherwise(
        F.element_at(shift, F.col("target") + 1) + F.col("over")
    )
    return ranked.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.coalesce("target", "shard").cast("int").alias("shard"),
        slot.cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
