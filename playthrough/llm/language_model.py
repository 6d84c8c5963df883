"""An n-gram language model by deleted interpolation, and the log probability of every document.

A token's probability mixes the maximum-likelihood estimates of its trigram, bigram and unigram and a uniform share.
The weights of the mixture belong to buckets of the context's frequency. They are learned by expectation-maximisation
on a held-out part of the training documents, with that part deleted from the counts; the scores use all counts.

Documents are read into chunks of a bounded number of tokens, stored as numbers. Each chunk's distinct n-grams are
sent, packed, to the buckets of their hashes. A bucket adds up the counts and answers each chunk with those of the
n-grams it asked for. The answers meet the chunk again, and every token is scored where all its counts are. A frequent
n-gram is one number per chunk. No text is shuffled, and only weights, a few numbers per bucket of frequency, come to
the driver.

Words are known by 64-bit hashes, pairs and triples by 47 bits or more, a bit more with each doubling of the corpus.
Two of 10^7 words share a hash with a probability of 3 in a million. Of 10^8 pairs and triples in a corpus of a
gigabyte one in a million counts together with another; the words' counts are not concerned.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playthrough.llm.common import ship_code, store, text_or_empty
from playthrough.llm.ngram_join import _mixed, _parts, _word_hashes
from playthrough.llm.packed import ascending, counts_of, from_ascending, from_planes, packed_counts, planes

#: Documents whose hash leaves this remainder are not learned from.
FOLDS, LEFT_OUT = 7, 2
#: Of the training documents, one of so many is held out to learn the weights.
HELD_OUT_OF = 16
#: Tokens of a chunk.
CHUNK = 1_500_000
#: Events of the held-out part in a row.
EVENTS_PER_ROW = 2**16
#: Tokens that are scored at once.
AT_ONCE = 2**18
#: Bytes of text per bucket of hashes on average, and powers of two of their number.
PER_BUCKET = 4_000_000
LEAST_BITS, MOST_BITS = 7, 22
#: Rounds of expectation-maximisation, at most, and the change of a weight below which they end.
ROUNDS = 20
SETTLED = 1e-3

_M = np.uint64(0x9E3779B97F4A7C15)
#: Bytes that a bucket leaves of a pair's or triple's hash.
_LEFT = 5
#: What comes before the first word and after the last; no word has these hashes but by chance.
BEGIN, END = np.uint64(0x5BF0A8B1457695F1), np.uint64(0x7F4A7C159E3779B9)
#: Kinds of buckets of context frequency: bits of the count of the two words before, else of the one before, else none.
CLASSES = 130
MIXED = 4

ORDERS = ["words", "pairs", "triples"]
#: A chunk: its distinct words, where its tokens' words are among them, and its documents.
CHUNKS = "chunk long, held_out boolean, words binary, places binary, docs binary"
_CHUNKS = pa.schema(
    [("chunk", pa.int64()), ("held_out", pa.bool_()), ("words", pa.binary()), ("places", pa.binary()), ("docs", pa.binary())]
)
ASKED = "bucket long, chunk long, held_out boolean, " + ", ".join(f"{o} binary, {o}_n binary" for o in ORDERS)
_ASKED = pa.schema(
    [("bucket", pa.int64()), ("chunk", pa.int64()), ("held_out", pa.bool_())]
    + [(c, pa.binary()) for o in ORDERS for c in (o, f"{o}_n")]
)
TOTALS = ["distinct", "n", "deleted", "opened", "opened_deleted"]
ANSWERED = "chunk long, bucket long, held_out boolean, words binary, pairs binary, triples binary, " + ", ".join(f"{t} long" for t in TOTALS)
_ANSWERED = pa.schema(
    [("chunk", pa.int64()), ("bucket", pa.int64()), ("held_out", pa.bool_()), *[(o, pa.binary()) for o in ORDERS]]
    + [(t, pa.int64()) for t in TOTALS]
)
SCORED = "row long, doc_id long, left_out boolean, n_tokens long, n_known long, base_score double, score double"
EVENTS = "events binary"


# --- n-grams of a chunk


def _combined(first: np.ndarray, second: np.ndarray, seed: int) -> np.ndarray:
    return _mixed((first * _M) ^ (second + np.uint64(seed)))


def _width(bits: int, order: int) -> int:
    """Bits of a hash that are kept: of n-grams longer than a word, as many as bucket and ``_LEFT`` bytes hold."""
    return 64 if order == 0 else min(64, bits + 8 * _LEFT)


def _bucket_of(hashes: np.ndarray, bits: int, order: int) -> np.ndarray:
    return (hashes >> np.uint64(_width(bits, order) - bits)).astype(np.int64)


class Grams:
    """n-grams of a chunk's pieces; each piece begins with the two tokens before it.

    ``known`` are the distinct hashes of words, pairs and triples, ascending; ``place`` has where those of each
    token are. A pair or triple ends at its token. The pair of a piece's first two tokens is the context of the third.
    """

    def __init__(self, words: np.ndarray, place: np.ndarray, lengths: np.ndarray, bits: int):
        tokens = words[place]
        starts = np.cumsum(lengths) - lengths
        counts = np.ones(len(tokens), dtype=bool)
        counts[starts] = counts[starts + 1] = False
        #: Tokens that are the chunk's own.
        self.at = np.flatnonzero(counts)
        pairs = _combined(tokens[:-1], tokens[1:], 2)
        triples = _combined(pairs[self.at - 1], tokens[self.at - 2], 3)
        self.opens = tokens[self.at - 1] == BEGIN
        self.opens_both = self.opens & (tokens[self.at - 2] == BEGIN)
        del tokens
        self.known, self.place = [words], [place]
        for order, hashes in enumerate((pairs, triples), 1):
            known, place = _distinct(hashes >> np.uint64(64 - _width(bits, order)))
            self.known.append(known)
            self.place.append(place)

    def own_places(self) -> list[np.ndarray]:
        """Where word, pair and triple of each own token are."""
        return [self.place[0][self.at], self.place[1][self.at - 1], self.place[2]]


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, ascending, and the place of each value among them."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    new = np.ones(len(values), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    place = np.empty(len(values), dtype=np.uint32)
    place[order] = np.cumsum(new) - 1
    return ordered[new], place


def _pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays one after the other, behind their lengths."""
    return b"".join([np.array([len(arrays), *map(len, arrays)], "<i8").tobytes(), *[a.tobytes() for a in arrays]])


def _unpack(packed: bytes, dtypes: list[str]) -> list[np.ndarray]:
    n = len(dtypes)
    lengths = np.frombuffer(packed, "<i8", n, 8)
    found, at = [], 8 * (n + 1)
    for dtype, length in zip(dtypes, lengths.tolist()):
        found.append(np.frombuffer(packed, dtype, length, at))
        at += length * np.dtype(dtype).itemsize
    return found


ROWS = ["<i8", "<i8", "<i8", "|u1"]


class Chunk:
    """Documents, or parts of very long ones, whose n-grams are sent together."""

    def __init__(self, number: int, held_out: bool):
        self.number, self.held_out = number, held_out
        self.pieces: list[np.ndarray] = []
        self.rows: list[tuple[int, int | None, int]] = []
        self.size = 0

    def add(self, row: int, doc_id: int | None, kind: int, tokens: np.ndarray) -> None:
        self.pieces.append(tokens)
        self.rows.append((row, doc_id, kind))
        self.size += len(tokens) - 2

    def written(self) -> pa.RecordBatch:
        """Words by falling frequency, so that most places are small numbers."""
        words, place = _distinct(np.concatenate(self.pieces))
        order = np.argsort(-np.bincount(place), kind="stable")
        rank = np.empty(len(words), np.uint32)
        rank[order] = np.arange(len(words))
        lengths = [len(p) for p in self.pieces]
        rows = [np.array(x, "<i8") for x in ([r[0] for r in self.rows], [r[1] or 0 for r in self.rows], lengths)]
        flags = np.array([kind | (4 if doc_id is None else 0) for _, doc_id, kind in self.rows], np.uint8)
        values = (self.number, self.held_out, words[order].astype("<u8").tobytes(), planes(rank[place], 0), _pack([*rows, flags]))
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _CHUNKS)], schema=_CHUNKS)


class Read:
    """A stored chunk."""

    def __init__(self, words: bytes, places: bytes, docs: bytes, bits: int):
        hashes = np.frombuffer(words, "<u8")
        order = np.argsort(hashes)
        at = np.empty(len(order), np.uint32)
        at[order] = np.arange(len(order))
        self.rows, self.ids, lengths, self.kinds = _unpack(docs, ROWS)
        self.lengths = lengths - 2
        self.bits = bits
        self.grams = Grams(hashes[order], at[from_planes(places).astype(np.int64)], lengths, bits)

    def asked(self, chunk: int, held_out: bool) -> pa.RecordBatch:
        """The distinct n-grams and how often each is learned from, a row per bucket."""
        learned = np.repeat(self.kinds & 3 != 1, self.lengths)
        buckets = 1 << self.bits
        low = [np.uint64((1 << _width(self.bits, k) - self.bits) - 1) for k in range(len(ORDERS))]
        counts, cuts = [], []
        for order, (known, place) in enumerate(zip(self.grams.known, self.grams.own_places())):
            counts.append(np.bincount(place[learned], minlength=len(known)))
            cuts.append(np.searchsorted(_bucket_of(known, self.bits, order), np.arange(buckets + 1)))
        columns: list[list] = [[] for _ in _ASKED]
        for b in np.flatnonzero(sum(np.diff(c) for c in cuts)).tolist():
            row = [b, chunk, held_out]
            for known, n, cut, mask in zip(self.grams.known, counts, cuts, low):
                part = slice(int(cut[b]), int(cut[b + 1]))
                row += [ascending(known[part] & mask), packed_counts(n[part])]
            for column, value in zip(columns, row):
                column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ASKED)], schema=_ASKED)


def _tokens(text: str) -> Iterator[np.ndarray]:
    """Hashes of a text's words and its end, in parts that each begin with the two tokens before."""
    before = np.array([BEGIN, BEGIN])
    held, n = [], 0
    for part in _parts(text.encode("utf-8", "surrogatepass").lower()):
        held.append(_word_hashes(part))
        n += len(held[-1])
        if n >= CHUNK:
            piece = np.concatenate([before, *held])
            yield piece
            before, held, n = piece[-2:], [], 0
    yield np.concatenate([before, *held, np.array([END])])


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and chunks are numbered by task."""
    task = TaskContext.get().partitionId() << 32
    made, row = 0, task
    open_chunks: dict[bool, Chunk] = {}
    for batch in batches:
        ids, kinds = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        for doc_id, kind, text in zip(ids, kinds, batch.column(1)):
            row += 1
            for piece in _tokens(text.as_py()):
                held_out = kind == 2
                if held_out not in open_chunks:
                    open_chunks[held_out] = Chunk(task + made, held_out)
                    made += 1
                chunk = open_chunks[held_out]
                chunk.add(row, doc_id, kind, piece)
                if chunk.size >= CHUNK:
                    yield open_chunks.pop(held_out).written()
    for chunk in open_chunks.values():
        yield chunk.written()


def _ask(bits: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, held_out, words, places, docs in zip(*batch.columns):
                yield Read(words.as_py(), places.as_py(), docs.as_py(), bits).asked(number.as_py(), held_out.as_py())

    return ask


# --- counts


def _total(parts: list[np.ndarray], counts: list[np.ndarray], held_out: list[bool]):
    """Per part, the sums over all parts and over the held-out ones; and all distinct hashes with both."""
    every, n = np.concatenate(parts), np.concatenate(counts)
    if not len(every):
        return [(n, n)] * len(parts), every, n, n
    deleted = np.where(np.repeat(np.array(held_out), [len(p) for p in parts]), n, 0)
    # Each part ascends, and a stable sort merges what is in order already.
    order = np.argsort(every, kind="stable")
    ordered = every[order]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    lengths = np.diff(np.r_[starts, len(every)])
    sums, by_part = [], []
    for values in (n, deleted):
        sums.append(np.add.reduceat(values[order], starts))
        spread = np.empty(len(every), np.int64)
        spread[order] = np.repeat(sums[-1], lengths)
        by_part.append(np.split(spread, np.cumsum([len(p) for p in parts])[:-1]))
    return list(zip(*by_part)), ordered[starts], *sums


def _answer(bits: int):
    def answer(table: pa.Table) -> pa.Table:
        """Counts for each chunk that has asked, in the order it asked in; and the bucket's totals."""
        held_out = table["held_out"].to_pylist()
        bucket = table["bucket"][0].as_py()
        answers: list[list] = [[] for _ in held_out]
        for order, name in enumerate(ORDERS):
            hashes = [from_ascending(x.as_py()) for x in table[name]]
            counts = [counts_of(x.as_py(), len(h)) for x, h in zip(table[f"{name}_n"], hashes)]
            by_part, found, sums, deleted = _total(hashes, counts, held_out)
            for row, (every, less), held in zip(answers, by_part, held_out):
                # A held-out chunk also needs what is deleted when the weights are learned.
                row.append(packed_counts(np.concatenate([every, less]) if held else every))
            if order == 0:
                end = found == END & np.uint64((1 << 64 - bits) - 1) if bucket == int(END) >> 64 - bits else found < 0
                numbers = [(sums > 0).sum(), sums.sum(), deleted.sum(), sums[end].sum(), deleted[end].sum()]
        totals = [[int(x)] + [None] * (len(held_out) - 1) for x in numbers]
        columns = [table["chunk"], table["bucket"], held_out, *zip(*answers), *totals]
        return pa.table([pa.array(c, f.type) if not isinstance(c, pa.ChunkedArray) else c for c, f in zip(columns, _ANSWERED)], schema=_ANSWERED)

    return answer


class Totals:
    """What is known of the whole training text: tokens, distinct tokens, documents."""

    def __init__(self, tokens: int, distinct: int, documents: int):
        self.tokens, self.distinct, self.documents = tokens, distinct, documents


class Counted(Read):
    """A chunk with the counts of all its n-grams: one row of chunks, and the answers to it."""

    def __init__(self, own: pa.Table, answers: pa.Table, bits: int):
        super().__init__(*[own[c][0].as_py() for c in ("words", "places", "docs")], bits)
        buckets = answers["bucket"].to_numpy()
        order = np.argsort(buckets)
        held_out = own["held_out"][0].as_py()
        #: A value for each known word, pair and triple; for a held-out chunk the part to be deleted too.
        self.counts, self.deleted = [], []
        for k, (name, known) in enumerate(zip(ORDERS, self.grams.known)):
            cuts = np.searchsorted(_bucket_of(known, bits, k), buckets[order])
            asked = np.diff(np.r_[cuts, len(known)]).tolist()
            cells = [answers[name][int(row)].as_py() for row in order]
            found = [counts_of(cell, 2 * n if held_out else n) for cell, n in zip(cells, asked)]
            self.counts.append(np.concatenate([f[:n] for f, n in zip(found, asked)]))
            if held_out:
                self.deleted.append(np.concatenate([f[n:] for f, n in zip(found, asked)]))

    def of(self, totals: Totals, tokens: np.ndarray | slice, deleted: bool = False):
        """Counts of triple, the pair before, pair, the word before and word, for the given own tokens."""
        words, pairs, triples = [c - d for c, d in zip(self.counts, self.deleted)] if deleted else self.counts
        (word, pair, triple), at = self.grams.place, self.grams.at[tokens]
        # Nothing but a document's begin comes before it, so its count is that of the documents.
        after = np.where(self.grams.opens[tokens], totals.documents, words[word[at - 1]])
        after_both = np.where(self.grams.opens_both[tokens], totals.documents, pairs[pair[at - 2]])
        return triples[triple[tokens]], after_both, pairs[pair[at - 1]], after, words[word[at]]


def frequency_class(after_two: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Bucket of the context: by the bits of the longest known context's count."""

    def bits(n):
        return np.frexp(n.astype(np.float64))[1]

    return np.where(after_two > 0, 65 + bits(after_two), np.where(after > 0, bits(after), 0)).astype(np.int64)


def estimates(counts, totals: Totals) -> np.ndarray:
    """Maximum-likelihood estimates of every token: trigram, bigram, unigram, uniform. Unknown contexts give 0."""
    c3, after_two, c2, after, c1 = (c.astype(np.float64) for c in counts)
    uniform = np.full(len(c1), 1.0 / (totals.distinct + 1))
    return np.stack(
        [c3 / np.maximum(after_two, 1), c2 / np.maximum(after, 1), c1 / max(totals.tokens, 1), uniform], axis=1
    )


def _open(classes: np.ndarray) -> np.ndarray:
    """Which estimates exist in a class of contexts."""
    exists = np.ones((len(classes), MIXED), dtype=bool)
    exists[:, 0], exists[:, 1] = classes > 65, classes > 0
    return exists


def first_weights(totals: Totals) -> np.ndarray:
    weights = _open(np.arange(CLASSES)).astype(np.float64)
    if not totals.tokens:
        weights[:, 2] = 0.0
    return weights / weights.sum(axis=1, keepdims=True)


# --- weights and scores


def _events(bits: int, totals: Totals):
    """Held-out tokens of a chunk as (class, estimates, how many), with the held-out part deleted from the counts.

    The uniform share is the same for all and left out. Seven digits of an estimate are enough for a weight.
    """

    def make(own: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = Counted(own, answers, bits)
        # Tokens with the same triple have the same counts.
        triple = chunk.grams.place[2]
        times = np.bincount(triple)
        first = np.empty(len(times), np.int64)
        first[triple] = np.arange(len(triple))
        counts = chunk.of(totals, first, deleted=True)
        classes = frequency_class(counts[1], counts[3])
        found = estimates(counts, totals)[:, : MIXED - 1]
        rows = [slice(at, at + EVENTS_PER_ROW) for at in range(0, len(times), EVENTS_PER_ROW)]
        packed = [_pack([classes[r].astype("|u1"), found[r].ravel().astype("<f4"), times[r].astype("<u4")]) for r in rows]
        return pa.table({"events": pa.array(packed, pa.binary())})

    return make


def _expected(weights: np.ndarray, uniform: float):
    """Expected uses of each estimate per class, added up per task."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses = np.zeros((CLASSES, MIXED))
        for batch in batches:
            for packed in batch.column(0):
                classes, found, times = _unpack(packed.as_py(), ["|u1", "<f4", "<u4"])
                mixed = np.full((len(classes), MIXED), uniform)
                mixed[:, : MIXED - 1] = found.reshape(-1, MIXED - 1)
                mixed *= weights[classes]
                mixed *= (times / mixed.sum(axis=1))[:, None]
                for k in range(MIXED):
                    uses[:, k] += np.bincount(classes, mixed[:, k], CLASSES)
        met = np.flatnonzero(uses.sum(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(met, pa.int64()), *[pa.array(uses[met, k], pa.float64()) for k in range(MIXED)]],
            ["class", *[f"u{k}" for k in range(MIXED)]],
        )

    return add


def learned_weights(events: DataFrame, totals: Totals) -> np.ndarray:
    """Expectation-maximisation; each estimate counts once more than it is used, so that no weight is zero."""
    weights, uniform = first_weights(totals), 1.0 / (totals.distinct + 1)
    exists = weights > 0
    columns = [f"u{k}" for k in range(MIXED)]
    schema = "class long, " + ", ".join(f"{c} double" for c in columns)
    for _ in range(ROUNDS):
        sums = events.mapInArrow(_expected(weights, uniform), schema).groupBy("class").agg(*[F.sum(c).alias(c) for c in columns])
        uses = np.zeros((CLASSES, MIXED))
        for r in sums.collect():  # a row per class
            uses[r["class"]] = [r[c] for c in columns]
        uses = np.where(exists, uses + 1, 0)
        before, weights = weights, uses / uses.sum(axis=1, keepdims=True)
        if np.abs(weights - before).max() < SETTLED:
            break
    return weights


def _scored(bits: int, totals: Totals, weights: np.ndarray):
    def make(own: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = Counted(own, answers, bits)
        n = int(chunk.lengths.sum())
        score, base, known = np.empty(n), np.empty(n), np.empty(n, np.int64)
        for at in range(0, n, AT_ONCE):
            part = slice(at, at + AT_ONCE)
            counts = chunk.of(totals, part)
            score[part] = np.log10((estimates(counts, totals) * weights[frequency_class(counts[1], counts[3])]).sum(axis=1))
            base[part] = np.log10(counts[4] + 1)
            known[part] = counts[4] > 0
        base -= math.log10(totals.tokens + totals.distinct + 1)
        starts = np.cumsum(chunk.lengths) - chunk.lengths
        none = (chunk.kinds & 4) > 0
        return pa.table(
            {
                "row": pa.array(chunk.rows, pa.int64()),
                "doc_id": pa.array(chunk.ids, pa.int64(), mask=none),
                "left_out": pa.array((chunk.kinds & 3) == 1, pa.bool_()),
                "n_tokens": pa.array(chunk.lengths, pa.int64()),
                "n_known": pa.array(np.add.reduceat(known, starts), pa.int64()),
                "base_score": pa.array(np.add.reduceat(base, starts), pa.float64()),
                "score": pa.array(np.add.reduceat(score, starts), pa.float64()),
            }
        )

    return make


def score(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A null or empty text is its end alone. A null id counts as an empty one in the folds; rows that repeat an id are
    documents of their own. If no document is learned from, no token is known, and all are equally likely. Columns
    other than doc_id and text are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship_code(spark)
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    fold = F.crc32(id_text.cast("binary")) % FOLDS
    tuning = F.crc32(F.concat(id_text, F.lit(":held out")).cast("binary")) % HELD_OUT_OF == 0
    kind = F.when(fold == LEFT_OUT, 1).when(tuning, 2).otherwise(0)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), kind.alias("kind"))
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(1, n_bytes / PER_BUCKET)))))

    chunks = store(texts.mapInArrow(_written, CHUNKS), "chunks")
    answers = chunks.mapInArrow(_ask(bits), ASKED).groupBy("bucket").applyInArrow(_answer(bits), ANSWERED)
    answers = store(answers, "counts")
    sums = answers.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in TOTALS]).first()
    totals = Totals(sums["n"], sums["distinct"], sums["opened"])
    without = Totals(sums["n"] - sums["deleted"], sums["distinct"], sums["opened"] - sums["opened_deleted"])

    asked = answers.select("chunk", "bucket", *ORDERS)
    tuning = chunks.filter("held_out").groupBy("chunk").cogroup(answers.filter("held_out").select(asked.columns).groupBy("chunk"))
    events = store(tuning.applyInArrow(_events(bits, without), EVENTS), "events")
    weights = learned_weights(events, totals=without)
    pieces = chunks.groupBy("chunk").cogroup(asked.groupBy("chunk")).applyInArrow(_scored(bits, totals, weights), SCORED)
    added = [F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]
    rows = pieces.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("left_out").alias("held_out"), *added)
    return rows.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(totals.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
