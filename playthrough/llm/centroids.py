"""Clusters of vectors around integer centroids, with dot products that are updated instead of made anew.

Each vector keeps its exact integer dot product with every centroid. When a round moves the centroids, only the
components that changed are multiplied, and the difference is added to the stored products; the squared distances
follow from the products and the lengths. A round reads the stored table once and writes its successor, which then
gives the sums per cluster; the table before it is deleted. A lost executor costs the tasks it was running.

What comes to the driver are the centroids: ``CLUSTERS`` times the number of components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playthrough.llm.common import remove, ship_code, store

COMPONENTS = 64
CLUSTERS = 40
ROUNDS = 5
SCALE = 256
#: Components beyond this are set to it, so that every distance fits in 64 bits.
LARGEST = 2**26

STATE = "vec_id long, units binary, dots binary, cluster int, distance long"
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and integer components of the vectors with exactly ``COMPONENTS`` finite numbers."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.coalesce((F.size("embedding") == COMPONENTS) & finite, F.lit(False))

    def unit(x):
        return F.floor(F.least(F.greatest(SCALE * x.cast("double"), F.lit(-float(LARGEST))), F.lit(float(LARGEST))))

    return embeddings.filter(whole).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", unit).alias("units"))


def first_centroids(vectors: DataFrame) -> np.ndarray:
    """The vectors whose ids have the smallest hashes, in that order; rows that repeat an id by their components."""
    drawn = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.filter("vec_id is not null").select(drawn.alias("drawn"), "units").orderBy("drawn", "units").limit(CLUSTERS)
    return np.array([r["units"] for r in rows.collect()], dtype=np.int64).reshape(-1, COMPONENTS)


def _matrix(column: pa.Array, dtype: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(-1, width).astype(np.int64)


def _started(k: int):
    """Components packed, all products zero."""

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = bytes(8 * k)
        for batch in batches:
            units = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype("<i4").reshape(-1, COMPONENTS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([u.tobytes() for u in units], pa.binary()), pa.array([none] * len(units), pa.binary())],
                ["vec_id", "units", "dots"],
            )

    return start


def moved(units: np.ndarray, dots: np.ndarray, change: np.ndarray) -> np.ndarray:
    """The dot products after the centroids have changed: only components that are not zero in ``change`` count."""
    dots = dots.copy()
    for c, row in enumerate(change):
        used = np.flatnonzero(row)
        if len(used):
            dots[:, c] += units[:, used] @ row[used]
    return dots


def _assigned(change: np.ndarray, centroids: np.ndarray):
    lengths = (centroids * centroids).sum(axis=1)
    k = len(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = _matrix(batch.column(1), "<i4", COMPONENTS)
            dots = moved(units, _matrix(batch.column(2), "<i8", k), change)
            distances = (units * units).sum(axis=1)[:, None] - 2 * dots + lengths
            nearest = distances.argmin(axis=1)  # the first of equal ones
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([d.tobytes() for d in dots.astype("<i8")], pa.binary()),
                    pa.array(nearest.astype(np.int32), pa.int32()),
                    pa.array(distances[np.arange(len(nearest)), nearest], pa.int64()),
                ],
                ["vec_id", "units", "dots", "cluster", "distance"],
            )

    return assign


def _summed(k: int):
    """Vectors, components and distances added up per cluster, once per task."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, away = np.zeros((k, COMPONENTS), np.int64), np.zeros(k, np.int64), [0] * k
        for batch in batches:
            cluster = batch.column(0).to_numpy()
            units = _matrix(batch.column(1), "<i4", COMPONENTS)
            distance = batch.column(2).to_numpy()
            for c in np.unique(cluster).tolist():
                own = cluster == c
                sums[c] += units[own].sum(axis=0)
                counts[c] += own.sum()
                away[c] += sum(distance[own].tolist())
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(met.astype(np.int32), pa.int32()),
                pa.array(counts[met], pa.int64()),
                pa.array([str(away[c]) for c in met.tolist()], pa.string()),
                pa.array(sums[met].tolist(), pa.list_(pa.int64())),
            ],
            ["cluster", "n", "away", "sums"],
        )

    return add


def _cluster_sums(state: DataFrame, k: int) -> dict[int, tuple[int, int, list[int]]]:
    """Per cluster with vectors: their number, the sum of their distances, the sums of their components."""
    partial = state.select("cluster", "units", "distance").mapInArrow(_summed(k), "cluster int, n long, away string, sums array<long>")
    exact = "decimal(38,0)"
    columns = [F.sum(F.col("sums")[j].cast(exact)).alias(f"s{j}") for j in range(COMPONENTS)]
    rows = partial.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum(F.col("away").cast(exact)).alias("away"), *columns)
    return {r["cluster"]: (r["n"], int(r["away"]), [int(r[f"s{j}"]) for j in range(COMPONENTS)]) for r in rows.collect()}


def cluster(embeddings: DataFrame) -> DataFrame:
    """One row per usable vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors that are null, have another number of components, or hold a null or a number that is not finite are left
    out. A row without an id is assigned, but starts no cluster; rows that repeat an id are vectors of their own.
    With fewer vectors than ``CLUSTERS`` each of them starts one. A sum of distances beyond 64 bits is null.
    Other columns are ignored; an empty table gives an empty result.
    """
    spark = embeddings.sparkSession
    ship_code(spark)
    vectors = usable(embeddings)
    centroids = first_centroids(vectors)
    k = len(centroids)
    if not k:
        return spark.createDataFrame([], RESULT)
    state = vectors.mapInArrow(_started(k), "vec_id long, units binary, dots binary")
    before = np.zeros_like(centroids)
    for turn in range(ROUNDS + 1):
        found = state.select("vec_id", "units", "dots").mapInArrow(_assigned(centroids - before, centroids), STATE)
        found = store(found, "distances")
        if turn:
            remove(state)
        state, before = found, centroids
        of = _cluster_sums(state, k)
        if turn < ROUNDS:
            means = [[s // of[c][0] for s in of[c][2]] if c in of else centroids[c].tolist() for c in range(k)]
            centroids = np.array(means, dtype=np.int64)
            if (centroids == before).all():
                break  # the rounds that are left would change nothing
    inertia = sum(away for _, away, _ in of.values())
    hashes = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in before.tolist()]

    def fits(n: int) -> int | None:
        return n if n < 2**63 else None

    totals = [(c, fits(away), fits(inertia), hashes[c]) for c, (_, away, _) in of.items()]
    # A row per cluster: at most CLUSTERS.
    table = F.broadcast(spark.createDataFrame(totals, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"))
    return state.select("vec_id", "cluster", "distance").join(table, "cluster").select(*[f.split()[0] for f in RESULT.split(", ")])
