"""Pack documents into sequences of a fixed number of tokens: cutting stock by column generation.

Each document is cut into pieces of a whole sequence and one remainder. Remainders are what has to be
packed. Their lengths form a histogram of bounded size; a linear program over patterns (multisets of
lengths that fit into a sequence) covers it, a knapsack dynamic program prices new patterns, and the rounded
patterns are dealt to the remainders, ranked within their length class. Only the histogram and the
patterns pass through the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playthrough.llm.common import buckets_for, hash_bucket, running, ship_code, store, text_or_empty
from playthrough.llm.tokens import word_ids

CAPACITY = 2048
#: Lengths are rounded up to multiples of this for the program; patterns hold CAPACITY / GRAIN units.
GRAIN = 8
END_ID = 1
#: Pivots of the linear program, at most; any basis gives a valid packing.
PIVOTS = 5000
#: Share by which the number of patterns may exceed the least one.
GAP = 0.005

PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _pieces(path: str, capacity: int, end_id: int):
    end = np.array([end_id], dtype="<u4").tobytes()
    step = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(path)
        for batch in batches:
            rows = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = words.of_text(text.as_py()) + end
                for at in range(0, len(ids), step):
                    piece = ids[at : at + step]
                    for column, value in zip(rows, (doc_id, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=pa.int64()) for c in rows],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    return cut


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: whole sequences and the remainder of each document."""
    ship_code(docs.sparkSession)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return read.mapInArrow(_pieces(tokenizer_path, capacity, end_id), PIECE_SCHEMA)


def price(values: np.ndarray, sizes: np.ndarray, units: int) -> tuple[float, np.ndarray]:
    """The pattern of most value: unbounded knapsack over ``units``, by dynamic programming."""
    best, taken = np.zeros(units + 1), np.full(units + 1, -1)
    for room in range(1, units + 1):
        usable = np.searchsorted(sizes, room, side="right")
        best[room], taken[room] = best[room - 1], -1
        if usable:
            with_item = values[:usable] + best[room - sizes[:usable]]
            k = int(with_item.argmax())
            if with_item[k] > best[room] + 1e-12:
                best[room], taken[room] = with_item[k], k
    pattern, room = np.zeros(len(sizes)), units
    while room > 0:
        if taken[room] < 0:
            room -= 1
        else:
            pattern[taken[room]] += 1
            room -= sizes[taken[room]]
    return best[units], pattern


def cutting_stock(sizes: np.ndarray, demand: np.ndarray, units: int, pivots: int = PIVOTS):
    """Columns and amounts of a basic solution of: least number of patterns that cover the demand exactly.

    Stops when no pattern is worth more than 1 + GAP, which bounds the distance to the optimum by that share.
    """
    first = (units // sizes).astype(float)
    columns, inverse = np.diag(first), np.diag(1 / first)
    amounts = demand / first
    for _ in range(pivots):
        value, pattern = price(inverse.sum(axis=0), sizes, units)
        if value <= 1 + GAP:
            break
        used = np.flatnonzero(pattern)
        change = (inverse[:, used] * pattern[used]).sum(axis=1)
        positive = change > 1e-9
        ratio = np.where(positive, amounts / np.where(positive, change, 1), np.inf)
        out = int(ratio.argmin())
        columns[:, out] = pattern
        step, row = ratio[out], inverse[out] / change[out]
        inverse -= change[:, None] * row
        inverse[out] = row
        amounts = np.maximum(amounts - step * change, 0)
        amounts[out] = step
    return columns, amounts


def plan(histogram: dict[int, int], units: int) -> list[tuple[dict[int, int], int]]:
    """Patterns {size: pieces} and how often each is used, so that every piece has a place.

    Amounts are rounded down; the few pieces left, a bounded number, are packed longest first.
    """
    sizes = np.array(sorted(histogram), dtype=int)
    if not len(sizes):
        return []
    demand = np.array([histogram[s] for s in sizes], dtype=float)
    columns, amounts = cutting_stock(sizes, demand, units)
    left, found = demand.astype(int), []
    for column, amount in zip(columns.T.astype(int), np.floor(amounts + 1e-6).astype(int)):
        used = column > 0
        amount = min(int(amount), int((left[used] // column[used]).min()))
        if amount > 0:
            found.append(({int(s): int(c) for s, c in zip(sizes[used], column[used])}, amount))
            left -= amount * column
    open_bins: list[list] = []
    for size in reversed([int(s) for s, n in zip(sizes, left) for _ in range(n)]):
        fitting = next((b for b in open_bins if b[0] >= size), None)
        if fitting is None:
            open_bins.append(fitting := [units, {}])
        fitting[0] -= size
        fitting[1][size] = fitting[1].get(size, 0) + 1
    return found + [(pattern, 1) for _, pattern in open_bins]


def _places(patterns: list[tuple[dict[int, int], int]]) -> tuple[list[tuple], int]:
    """Ranks of a class [lo, hi) fill ``per`` places in each of consecutive sequences from ``first``."""
    rows, ranks, first = [], {}, 0
    for pattern, amount in patterns:
        for size, per in pattern.items():
            lo = ranks.get(size, 0)
            ranks[size] = lo + per * amount
            rows.append((size, lo, ranks[size], first, per))
        first += amount
    return rows, first


def pack(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, grain: int = GRAIN, end_id: int = END_ID
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text is its end id alone. Rows that repeat an id are packed as documents of their own. Null
    ids are kept. Columns other than doc_id and text are ignored; an empty table gives an empty result.
    """
    cut = store(pieces(docs, tokenizer_path, capacity, end_id), "pieces")
    rest = cut.filter(F.col("length") < capacity).withColumn("units", F.ceil(F.col("length") / grain).cast("int"))
    counts = rest.groupBy("units").count().collect()  # capacity / grain rows at most
    rows, n_packed = _places(plan({r["units"]: r["count"] for r in counts}, capacity // grain))
    spark = docs.sparkSession
    places = spark.createDataFrame(rows, "of_units int, lo long, hi long, first long, per long")

    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("start"), F.col("ids_crc32")]
    n_buckets = buckets_for(max([0, *(r["count"] for r in counts)]))
    ranked = running(rest, ["units"], F.lit(1), hash_bucket(F.col("doc_id"), n_buckets), order, "rank")
    in_place = (F.col("units") == F.col("of_units")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    # At most a row per pattern and class, whatever the number of documents.
    dealt = ranked.join(F.broadcast(places), in_place)
    dealt = dealt.withColumn("sequence_id", F.col("first") + F.floor((F.col("rank") - F.col("lo")) / F.col("per")))
    earlier = (
        Window.partitionBy("sequence_id")
        .orderBy(F.col("length").desc(), "rank", "units")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    dealt = dealt.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0)))

    whole = cut.filter(F.col("length") == capacity)
    n_buckets = buckets_for(whole.count())
    whole = running(whole, [], F.lit(1), hash_bucket(F.col("doc_id"), n_buckets), order, "rank")
    whole = whole.withColumn("sequence_id", F.col("rank") + n_packed).withColumn("offset", F.lit(0).cast("long"))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return dealt.select(columns).unionByName(whole.select(columns))
