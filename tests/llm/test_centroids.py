"""Centroid clustering against plain integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from playthrough.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, units int, distance int"


def brute(rows):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if _usable(v)]
    drawn = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), u) for i, u in kept if i is not None)
    centers = [u for _, u in drawn[:40]]

    def nearest(u):
        return min((sum((a - b) ** 2 for a, b in zip(u, c)), k) for k, c in enumerate(centers))

    for _ in range(5):
        found = [nearest(u)[1] for _, u in kept]
        for c in range(len(centers)):
            own = [u for k, (_, u) in zip(found, kept) if k == c]
            if own:
                centers[c] = [sum(x) // len(own) for x in zip(*own)]
    last = [nearest(u) for _, u in kept]
    inertia = {c: sum(d for d, k in last if k == c) for c in range(len(centers))}
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted(
        (-1 if i is None else i, k, d, inertia[k], sum(inertia.values()), hashes[k]) for (i, _), (d, k) in zip(kept, last)
    )


def _usable(v):
    return v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)


def clustered(spark, rows):
    df = spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in rows], SCHEMA).repartition(3)
    found = centroids.cluster(df)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((-1 if r.vec_id is None else r.vec_id, *r[1:]) for r in found.collect())


def vectors(seed, n):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 0.5) for _ in range(64)] for _ in range(12)]
    return [(k, [float(np.float32(x + rng.gauss(0, 0.2))) for x in rng.choice(middles)]) for k in range(n)]


@pytest.mark.parametrize("n", [1, 25, 400])
def test_equals_plain_integers(spark, n):
    assert clustered(spark, vectors(n, n)) == brute(vectors(n, n))


def test_odd_rows(spark):
    rows = vectors(5, 60)
    same = rows[0][1]
    rows += [(100, None), (101, []), (102, same[:63]), (103, [*same[:63], None]), (104, [*same[:63], math.inf])]
    rows += [(105, [*same[:63], math.nan]), (106, same), (106, same), (106, rows[1][1]), (None, rows[2][1]), (107, [0.0] * 64)]
    assert clustered(spark, rows) == brute(rows)


def test_ties_go_to_the_smaller_number(spark):
    rows = [(k, [1.0] * 64) for k in range(50)]
    found = clustered(spark, rows)
    assert found == brute(rows) and {r[1] for r in found} == {0}


def test_no_vectors(spark):
    assert clustered(spark, [(1, [1.0])]) == []


def test_very_large_components(spark):
    found = clustered(spark, [(k, [3e38] + [0.0] * 63) for k in range(2)])
    assert [r[2] for r in found] == [0, 0]


def test_products_follow_the_centroids():
    rng = np.random.default_rng(3)
    units, old, new = (rng.integers(-300, 300, (n, 64)) for n in (50, 8, 8))
    new[3] = old[3]
    new[4, 5:] = old[4, 5:]
    assert (centroids.moved(units, units @ old.T, new - old) == units @ new.T).all()


def test_scratch_tables_do_not_pile_up(spark):
    """Of the stored distances only the last ones are left."""
    from playthrough.sources.checkpoint import shared_folder
    from pathlib import Path

    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.glob("llm-distances-*"))
    centroids.cluster(spark.createDataFrame([(i, v) for i, v in vectors(2, 80)], "vec_id long, embedding array<float>")).collect()
    assert len(set(folder.glob("llm-distances-*")) - before) == 1
