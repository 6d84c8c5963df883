"""Many users and chunks are walked in one call."""

import pyarrow as pa

from playthrough.operators import genres
from playthrough.operators.keysplits import CHUNK


def test_many_groups_in_one_call():
    rows = [
        ("a", 0, 1, "x", 1), ("a", 0, 5, "x", -1), ("a", 0, 5, "y", 1),
        ("a", 1, None, "x", 2), ("a", 1, None, "y", 3), ("a", 1, 7, "y", -1), ("a", 1, 8, "y", -1),
        ("b", 0, 7, "y", 1),
        (None, 0, 2, "y", 1), (None, 0, 9, "y", -1),
    ]
    names = ["user_id", CHUNK, "at", "genre", "step"]
    batches = [pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows[k : k + 2]]) for k in range(0, len(rows), 2)]
    found = [tuple(r.values()) for b in genres._walk(iter(batches)) for r in b.to_pylist()]
    assert found == [
        ("a", 1, "x"), ("a", 5, "y"), ("a", 7, "x"), ("b", 7, "y"), (None, 2, "y"), (None, 9, None),
    ]
    assert list(genres._walk(iter([]))) == []
