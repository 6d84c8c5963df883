"""Near-duplicate embeddings by spherical-cap filters.

Directions come from a product code: the dimensions are cut in two, each half has random unit vectors, and a
direction is a pair of them. A vector passes every direction whose cosine with it exceeds a limit, and its
``PASSED`` best ones whatever their cosine, so that recall does not fall as directions get many; the sums of two
sorted lists give these without going through all pairs. Vectors that pass the same direction are compared.
The number of directions grows with the number of vectors, so that a direction keeps some hundred of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playthrough.llm.common import ship_code, store
from playthrough.llm.graph import components

LEAST_COSINE = 0.95
#: Directions that each vector passes at least, and vectors per direction if it passes no more.
PASSED = 24
PER_DIRECTION = 256
#: Vectors of a direction that are compared in one piece; more are cut into blocks, compared two by two.
BLOCK = 1500
SEED = 11

ROWS = "direction long, vec_id long, copies long, vector binary, passes binary"
FOUND = "vec_id long, links long, root long"


def codes_for(n: int) -> tuple[int, float]:
    """Vectors per half, and the share of directions above the limit for Gaussian cosines."""
    per_half = max(8, math.ceil(math.sqrt(n * PASSED / PER_DIRECTION)))
    return per_half, min(0.5, PASSED / per_half**2)


def _codebooks(dimensions: int, per_half: int) -> list[np.ndarray]:
    rng = np.random.default_rng([SEED, dimensions, per_half])
    half = dimensions - dimensions // 2
    books = [rng.standard_normal((per_half, d)) for d in (half, dimensions - half)]
    return [b / np.maximum(np.sqrt((b * b).sum(axis=1, keepdims=True)), 1e-300) for b in books]


def passed_directions(x: np.ndarray, books: list[np.ndarray], share: float) -> np.ndarray:
    """Numbers of all directions that the unit vector x passes: those above the limit, and the PASSED best ones."""
    per_half = len(books[0])
    limit = NormalDist().inv_cdf(1 - share) / math.sqrt(len(x)) * math.sqrt(2)
    first = books[0] @ x[: books[0].shape[1]]
    second = books[1] @ x[books[0].shape[1] :] if books[1].shape[1] else np.zeros(per_half)
    order = np.argsort(-second, kind="stable")
    falling = -second[order]
    counts = np.searchsorted(falling, first - limit, side="right")
    # The k best pairs are among the k best of each half. Ties go by number, so that they add no directions.
    row, place = np.argsort(-first, kind="stable")[:PASSED], order[:PASSED]
    best = np.argsort(-(first[row][:, None] + second[place]), axis=None, kind="stable")[:PASSED]
    best = row[best // len(place)] * per_half + place[best % len(place)]
    rows = np.repeat(np.arange(per_half), counts)
    places = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.union1d(rows * per_half + order[places], best)


def _decode(per_half: int, share: float, dtype: str, only_numbers: bool):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            directions, vec_ids, copies, vectors, passes = [], [], [], [], []
            for vec_id, n, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                raw = np.array(values.as_py(), dtype=dtype)
                x = raw.astype(np.float64)
                x = x / np.abs(x).max()
                x /= np.sqrt((x * x).sum())
                d = len(x)
                if d not in books:
                    books[d] = _codebooks(d, per_half)
                # Vectors of different lengths never meet.
                found = passed_directions(x, books[d], share) + d * per_half**2
                directions.extend(found.tolist())
                if not only_numbers:
                    blob, all_found = raw.tobytes(), found.astype(np.int64).tobytes()
                    vec_ids += [vec_id] * len(found)
                    copies += [n] * len(found)
                    vectors += [blob] * len(found)
                    passes += [all_found] * len(found)
            column = pa.array(directions, pa.int64())
            if only_numbers:
                yield pa.RecordBatch.from_arrays([column], ["direction"])
            else:
                yield pa.RecordBatch.from_arrays(
                    [column, pa.array(vec_ids, pa.int64()), pa.array(copies, pa.int64()), pa.array(vectors, pa.binary()), pa.array(passes, pa.binary())],
                    ["direction", "vec_id", "copies", "vector", "passes"],
                )

    return decode


def _verify(least: float, dtype: str):
    def compare(table: pa.Table) -> pa.Table:
        direction = table["direction"][0].as_py()
        left_block, right_block = table["i"][0].as_py(), table["j"][0].as_py()
        ids = np.array(table["vec_id"].to_pylist())
        copies = np.array(table["copies"].to_pylist())
        block = np.array(table["block"].to_pylist())
        x = np.array([np.frombuffer(v, dtype=dtype) for v in table["vector"].to_pylist()], dtype=np.float64)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
        earlier = [np.frombuffer(p, dtype=np.int64) for p in table["passes"].to_pylist()]
        earlier = [p[p < direction] for p in earlier]
        left, right = np.flatnonzero(block == left_block), np.flatnonzero(block == right_block)
        links, root = np.zeros(len(ids), dtype=np.int64), ids.copy()
        parent = np.arange(len(ids))

        def find(k: int) -> int:
            while parent[k] != k:
                parent[k] = parent[parent[k]]
                k = parent[k]
            return k

        for at in range(0, len(left), 512):
            part = left[at : at + 512]
            close = x[part] @ x[right].T >= least
            if left_block == right_block:
                close &= part[:, None] < right[None, :]
            a, b = np.nonzero(close)
            if not len(a):
                continue
            a, b = part[a], right[b]
            # A pair counts in the first direction that both pass.
            met = sorted({*a.tolist(), *b.tolist()})
            numbers, at_row = {}, {k: i for i, k in enumerate(met)}
            cells = [(at_row[k], numbers.setdefault(int(f), len(numbers))) for k in met for f in earlier[k]]
            shared = np.zeros((len(met), max(1, len(numbers))), dtype=np.float32)
            if cells:
                shared[tuple(np.array(cells).T)] = 1
            ra, rb = np.array([at_row[k] for k in a.tolist()]), np.array([at_row[k] for k in b.tolist()])
            new = np.ones(len(a), dtype=bool)
            for s in range(0, len(a), 50_000):
                new[s : s + 50_000] = (shared[ra[s : s + 50_000]] * shared[rb[s : s + 50_000]]).sum(axis=1) == 0
            a, b = a[new], b[new]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            for p, q in zip(a.tolist(), b.tolist()):
                p, q = find(p), find(q)
                if p != q:
                    keep, gone = (p, q) if ids[p] < ids[q] else (q, p)
                    parent[gone] = keep
        hit = np.flatnonzero(links > 0)
        root = np.array([ids[find(int(k))] for k in hit], dtype=np.int64)
        return pa.table({"vec_id": pa.array(ids[hit], pa.int64()), "links": pa.array(links[hit], pa.int64()), "root": pa.array(root, pa.int64())})

    return compare


def near_duplicates(embeddings: DataFrame, least_cosine: float = LEAST_COSINE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Equal vectors are compared once and count with their number. Vectors that are null, empty, zero, or hold a null
    or a number that is not finite link with nothing; so do vectors of different lengths with each other. Rows that
    repeat an id are vectors of their own. Other columns, labels too, are ignored; an empty table gives an empty result.
    """
    spark = embeddings.sparkSession
    ship_code(spark)
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    element = embeddings.schema["embedding"].dataType.elementType.simpleString()
    dtype = "<f4" if element == "float" else "<f8"
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce(finite & F.exists("embedding", lambda v: v != 0) & F.col("vec_id").isNotNull(), F.lit(False))
    rows = store(rows.withColumn("usable", usable), "vectors")
    classes = rows.filter("usable").groupBy("embedding").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    # Numbers of their own, as two different vectors may have the same id.
    classes = store(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    per_half, share = codes_for(classes.count())

    source = classes.select("class", "copies", "embedding")
    numbers = source.mapInArrow(_decode(per_half, share, dtype, True), "direction long")
    crowded = numbers.groupBy("direction").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BLOCK)
    crowded = store(crowded.select("direction", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "crowded")
    passing = source.mapInArrow(_decode(per_half, share, dtype, False), ROWS).join(crowded, "direction", "left")
    blocks = F.coalesce("blocks", F.lit(1))
    passing = passing.withColumn("block", F.pmod(F.xxhash64("vec_id"), blocks).cast("int"))
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    passing = passing.withColumn("other", other).drop("blocks")
    passing = passing.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other")
    found = store(passing.groupBy("direction", "i", "j").applyInArrow(_verify(least_cosine, dtype), FOUND), "found")

    links = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    edges = found.select(F.col("vec_id").alias("a"), F.col("root").alias("b"))
    roots = components(edges).withColumnRenamed("node", "of_root")
    per_class = classes.join(links, classes["class"] == links["vec_id"], "left").drop("vec_id")
    per_class = per_class.join(roots, per_class["class"] == roots["of_root"], "left")
    per_class = store(
        per_class.select(
            F.col("embedding").alias("of"),
            "first",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "class").alias("component"),
        ),
        "per-class",
    )
    # A component of classes becomes one of vectors: known by the smallest id of any vector in it.
    smallest = store(per_class.groupBy("component").agg(F.min("first").alias("component_id")), "smallest")
    per_class = per_class.join(smallest, "component")
    linked = rows.filter("usable").join(per_class, F.col("embedding") == F.col("of")).select("vec_id", "n_links", "component_id")
    alone = rows.filter("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    every = linked.unionByName(alone)
    return every.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
