"""Quality of documents: random-indexing word vectors, pooled, and a small network.

Every word falls into one of a fixed number of cells. A cell's vector is the sum of the sparse random index vectors
of the words around its words, added up over all documents. A document is the mean and the spread of its words'
vectors, which a two-layer network turns into a probability; a temperature fitted on rows that the
network has not seen calibrates it. Tables that tasks share have a fixed size.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playthrough.llm.common import ship_code, store, text_or_empty

#: Cells for words, and dimensions of their vectors.
CELLS = 2**14
DIMENSIONS = 24
#: Non-zero entries of an index vector, words on either side that count as context.
ENTRIES = 2
REACH = 2
CELLS_PER_ROW = 256
#: Labelled rows that the network is fitted on, at most; one in five calibrates.
TRAINING_ROWS = 16_000
HIDDEN = 32
STEPS = 400
SEED = 7
#: Runs of characters a worker remembers; beyond, it starts anew.
REMEMBERED = 300_000
#: Words of a text whose vectors are in memory at once.
WORDS_AT_ONCE = 500_000

_WORD = re.compile(r"\w+|[^\w\s]+")


class _Cells(dict):
    """Run of characters -> cells of its words, as bytes of unsigned 16-bit numbers."""

    def __missing__(self, run: str) -> bytes:
        cells = [zlib.crc32(w.encode()) % CELLS for w in _WORD.findall(run)]
        found = np.array(cells, dtype=np.uint16).tobytes()
        if len(self) >= REMEMBERED:
            self.clear()
        self[run] = found
        return found


_cells = _Cells()


def _cells_of(text: str) -> np.ndarray:
    return np.frombuffer(b"".join(map(_cells.__getitem__, text.split())), dtype=np.uint16)


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries, per cell; the same everywhere."""
    rng = np.random.default_rng(SEED)
    return rng.integers(0, DIMENSIONS, (CELLS, ENTRIES)), rng.choice([-1.0, 1.0], (CELLS, ENTRIES))


def _add_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of index vectors around each cell over a partition, in rows of some cells each."""
    places, signs = _index_vectors()
    sums = np.zeros(CELLS * DIMENSIONS)
    for batch in batches:
        for text in batch.column(0):
            cells = _cells_of(text.as_py()).astype(np.int64)
            for at in range(0, len(cells), WORDS_AT_ONCE):
                part = cells[at : at + WORDS_AT_ONCE + REACH]
                for away in range(1, REACH + 1):
                    first, second = part[:-away][:WORDS_AT_ONCE], part[away:][:WORDS_AT_ONCE]
                    for word, context in ((first, second), (second, first)):
                        for k in range(ENTRIES):
                            np.add.at(sums, word * DIMENSIONS + places[context, k], signs[context, k])
    rows = sums.astype(np.int64).reshape(-1, CELLS_PER_ROW * DIMENSIONS)
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(len(rows)), pa.int32()), pa.array([r.tobytes() for r in rows], pa.binary())], ["part", "sums"]
    )


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, sums in zip(batch.column(0).to_pylist(), batch.column(1)):
            values = np.frombuffer(sums.as_py(), dtype=np.int64)
            total[part] = total[part] + values if part in total else values
    yield pa.RecordBatch.from_arrays(
        [pa.array(total, pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], ["part", "sums"]
    )


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Vector of unit length per cell, from all documents; a table of fixed size comes to the driver."""
    ship_code(docs.sparkSession)
    partial = docs.select(text_or_empty().alias("text")).mapInArrow(_add_contexts, "part int, sums binary")
    vectors = np.zeros((CELLS, DIMENSIONS))
    for row in partial.repartition("part").mapInArrow(_add_up, "part int, sums binary").collect():
        first = row["part"] * CELLS_PER_ROW
        vectors[first : first + CELLS_PER_ROW] = np.frombuffer(row["sums"], dtype=np.int64).reshape(-1, DIMENSIONS)
    length = np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    return (vectors / np.where(length > 0, length, 1)).astype(np.float32)


def pooled(vectors: np.ndarray, text: str) -> np.ndarray:
    """Mean and spread of the words' vectors and the logarithm of their number; zeros without words."""
    cells = _cells_of(text)
    n = len(cells)
    if not n:
        return np.zeros(2 * DIMENSIONS + 1, dtype=np.float32)
    total, squares = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
    for at in range(0, n, WORDS_AT_ONCE):
        part = vectors[cells[at : at + WORDS_AT_ONCE]]
        total += part.sum(axis=0, dtype=np.float64)
        squares += np.square(part).sum(axis=0, dtype=np.float64)
    mean = total / n
    spread = np.sqrt(np.maximum(squares / n - mean**2, 0))
    return np.concatenate([mean, spread, [np.log1p(n) / 10]]).astype(np.float32)


def pooled_documents(docs: DataFrame, vectors: np.ndarray) -> DataFrame:
    """doc_id, pooled (numbers as bytes)."""
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [pooled(shared.value, text.as_py()).tobytes() for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["doc_id", "pooled"])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return read.mapInArrow(pool, "doc_id long, pooled binary")


def fit(x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """A two-layer network by Adam on four rows of five, and the temperature that suits the fifth."""
    middle, width = x.mean(axis=0), x.std(axis=0) + 1e-6
    x = (x - middle) / width
    held = np.arange(len(y)) % 5 == 4
    rng = np.random.default_rng(SEED)
    p = {
        "w1": rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)),
        "b1": np.zeros(HIDDEN),
        "w2": rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
        "b2": np.zeros(1),
    }
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    xs, ys = x[~held], y[~held]
    for step in range(1, STEPS + 1):
        hidden = np.tanh(xs @ p["w1"] + p["b1"])
        error = (1 / (1 + np.exp(-(hidden @ p["w2"] + p["b2"]))) - ys) / len(ys)
        back = np.outer(error, p["w2"]) * (1 - hidden**2)
        slopes = {"w1": xs.T @ back + 1e-4 * p["w1"], "b1": back.sum(axis=0), "w2": hidden.T @ error, "b2": error.sum(keepdims=True)}
        for k, slope in slopes.items():
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.999 * second[k] + 0.001 * slope**2
            p[k] -= 0.01 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    net = p | {"middle": middle, "width": width, "temperature": np.ones(1)}
    if held.any():
        z, labels = logits(net, x[held] * width + middle), y[held]
        loss = lambda t: np.mean(np.logaddexp(0, np.where(labels == 1, -z, z) / t))
        net["temperature"] = np.array([min(np.exp(np.linspace(-1.5, 2.5, 81)), key=loss)])
    return net


def logits(net: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    x = (x - net["middle"]) / net["width"]
    z = np.tanh(x @ net["w1"] + net["b1"]) @ net["w2"] + net["b2"]
    return z / net["temperature"]


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _packed(net: dict[str, np.ndarray]) -> bytes:
    import io

    out = io.BytesIO()
    np.savez(out, **net)
    return out.getvalue()


def _fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    x, y = [], []
    for batch in batches:
        x += [np.frombuffer(b, dtype=np.float32) for b in batch.column(0).to_pylist()]
        y += batch.column(1).to_pylist()
    if x:
        net = fit(np.array(x, dtype=np.float64), np.array(y, dtype=np.float64))
        yield pa.RecordBatch.from_arrays([pa.array([_packed(net)], pa.binary())], ["net"])


def learn(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, DataFrame, bytes | None]:
    """Word vectors, stored pooled documents and the fitted network (none without a label to learn from)."""
    vectors = word_vectors(docs)
    features = store(pooled_documents(docs, vectors), "pooled")
    known = labels.filter("quality is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    learnt = features.join(known, "doc_id").filter(~held_out(F.col("doc_id")))
    sample = learnt.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAINING_ROWS).select("pooled", "quality")
    fitted = sample.coalesce(1).mapInArrow(_fit_rows, "net binary").collect()
    return vectors, features, fitted[0]["net"] if fitted else None


def _scores(net: bytes | None, x: np.ndarray) -> np.ndarray:
    import io

    if net is None:
        return np.full(len(x), 0.5)
    return 1 / (1 + np.exp(-logits(dict(np.load(io.BytesIO(net))), x)))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 if the score is 0.5 or more).

    ``labels`` has doc_id and quality (0 or 1; null is no label; of repeated labels of an id the smallest counts).
    A null text counts as empty; texts without words share one score. Without any label to learn from,
    every score is 0.5. Rows without an id are scored, not learnt from. Columns other than doc_id and text are
    ignored; an empty table gives an empty result.
    """
    _, features, net = learn(docs, labels)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.array([np.frombuffer(b, dtype=np.float32) for b in batch.column(1).to_pylist()], dtype=np.float64)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scores(net, x))], ["doc_id", "score"])

    scored = features.select("doc_id", "pooled").mapInArrow(apply, "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score is 0.5 or more, all columns kept; texts are scored where they are, not joined."""
    vectors, _, net = learn(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    text_at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                texts = batch.column(text_at)
                x = np.array([pooled(shared.value, text.as_py() or "") for text in texts], dtype=np.float64)
                yield batch.filter(pa.array(_scores(net, x) >= 0.5))

    return docs.mapInArrow(keep, docs.schema)
