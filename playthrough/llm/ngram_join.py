"""Near-duplicate texts: an exact Jaccard join of word n-gram sets, with prefix trees.

N-grams have one global order: rare ones first, by hash, then the most frequent ones, by their number of documents.
Two sets as similar as asked share an n-gram among the first ones of each (the prefix filter), so documents meet in
the lists of their prefixes' n-grams. Where the first n-gram they share lies in each of them tells how much they can
share at most: the smaller one of a pair needs it among so few first n-grams (one in seven) that members of a
list whose n-gram lies later can only be the larger one, and lists without a smaller one are dropped.

Of a list, first its members are compared with one of them, then those that are not connected with a few of the
largest component. What the found links still do not connect is compared pair by pair, so that thousands of copies
cost a link each and no link is lost.

Pairs are verified in tries: the sets to be compared with one set are put in the global order, frequent n-grams
first, so that sets with a common passage share a path and its partial overlap. A set ends as soon as the remaining
lengths cannot reach the overlap that is needed; where no set could, the whole subtree is left out.

N-grams travel as packed numbers, a row for each bucket of hashes. Sets are known by a hash of their members;
equal sets are one set from the start. No text is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playthrough.llm.common import ship_code, store, text_or_empty
from playthrough.llm.graph import components
from playthrough.llm.packed import ascending, counts_of, from_ascending, from_planes, packed_counts, planes

WORDS = 5
#: Least similarity as a fraction.
SIMILAR = (3, 4)
#: N-grams put last in the order: at most so many, each in so many documents at least. A hint for speed:
#: the join is exact with any order.
MOST_FREQUENT = 2**20
FREQUENT = 4
#: Classes of frequency per doubling: whole classes are put last.
CLASSES = 8
#: Bytes of text per bucket on average, and buckets at least.
PER_BUCKET = 50_000_000
LEAST_BUCKETS = 1024
#: N-grams a task holds before it sends them.
FLUSH = 3_000_000
#: Members of a list that are compared in one piece; longer lists are cut into blocks, taken two by two.
BLOCK = 2048
#: Members of a list's largest component that each other member is compared with, before all pairs are.
TRIES = 8
#: Times that this is done, with other members each time.
TURNS = 2
#: Sets compared with one set in one piece.
PARTNERS = 256
#: Bits of the map of documents that are needed, at most.
MOST_BITS = 2**28
#: Bytes of a text that are hashed at once.
PART = 2**22

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


#: Keeps so many bytes of eight, the first ones.
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
#: Longer words are hashed one by one.
LONG_WORD = 512
_IS_SPACE = np.isin(np.arange(256), [*range(0x09, 0x0E), 0x20])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _parts(text: bytes) -> Iterator[bytes]:
    """A long text in parts that end between words."""
    at = 0
    while len(text) - at > PART:
        end = next((k for k in range(at + PART, len(text)) if _IS_SPACE[text[k]]), len(text))
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def _word_hashes(text: bytes) -> np.ndarray:
    """A hash of each word, eight bytes of all words at a time."""
    padded = text + bytes(8)
    spaces = _IS_SPACE[np.frombuffer(padded, dtype=np.uint8)]
    spaces[len(text) :] = True
    changes = np.flatnonzero(spaces[1:] != spaces[:-1]) + 1
    if not spaces[0]:
        changes = np.concatenate(([0], changes))
    starts, lengths = changes[::2], changes[1::2] - changes[::2]
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    # Eight bytes from any place on.
    eight = np.ndarray(len(text), dtype="<u8", buffer=padded, strides=(1,))
    h = lengths.astype(np.uint64) * _MULTIPLIER
    open_words = np.flatnonzero(lengths <= LONG_WORD)
    at, left = starts[open_words], lengths[open_words]
    while len(open_words):
        value = eight[at] & _FIRST_BYTES[np.minimum(left, 8)]
        h[open_words] = _mixed((h[open_words] ^ value) * _MULTIPLIER)
        more = left > 8
        open_words, at, left = open_words[more], at[more] + 8, left[more] - 8
    for k in np.flatnonzero(lengths > LONG_WORD):
        import xxhash

        h[k] = xxhash.xxh3_64_intdigest(text[starts[k] : starts[k] + lengths[k]])
    return h


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))]


def shingles(text: str) -> np.ndarray:
    """Distinct hashes of the text's word n-grams, ascending; of all its words if they are fewer."""
    parts = [_word_hashes(part) for part in _parts(text.encode("utf-8", "surrogatepass").lower())]
    w = parts[0] if len(parts) == 1 else np.concatenate(parts)
    if not len(w):
        return w
    size = min(WORDS, len(w))
    n = len(w) - size + 1
    h = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        h = h * _MULTIPLIER + w[k : k + n]
    return _distinct(_mixed(h))


def set_id(grams: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes())).astype(np.int64))


def prefix_length(n: int) -> int:
    """A similar set shares one of so many n-grams, whichever they are."""
    part, whole = SIMILAR
    return n - -(-n * part // whole) + 1


def least_overlap(n: int, m: int) -> int:
    """overlap / (n + m - overlap) >= part / whole."""
    part, whole = SIMILAR
    return -(-part * (n + m) // (part + whole))


def _sizes_fit(n, m):
    part, whole = SIMILAR
    return (n * whole >= m * part) & (m * whole >= n * part)


def _cut(grams: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, list[slice]]:
    """The order of the n-grams by bucket and low half, the buckets, and where each lies in that order."""
    bucket = ((grams >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort((bucket.astype(np.uint64) << np.uint64(32)) | (grams & np.uint64(0xFFFFFFFF)))
    bucket = bucket[order]
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.empty(0, int)
    ends = np.r_[starts[1:], len(bucket)] if len(bucket) else starts
    return order, bucket[starts], [slice(s, e) for s, e in zip(starts.tolist(), ends.tolist())]


def _sent(buckets: np.ndarray, packed: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), pa.array(packed, pa.binary())], ["bucket", "packed"])


def _pack(parts: list[bytes]) -> bytes:
    return np.array([len(p) for p in parts], "<u4").tobytes() + b"".join(parts)


def _unpack(packed: bytes, n: int) -> list[bytes]:
    ends = np.cumsum(np.frombuffer(packed, "<u4", n)) + 4 * n
    return [packed[s:e] for s, e in zip([4 * n, *ends.tolist()], ends.tolist())]


def _counted(grams: np.ndarray, buckets: int) -> pa.RecordBatch:
    """How often each low half of an n-gram is met, by bucket."""
    order, found, parts = _cut(grams, buckets)
    low, packed = _low(grams[order]), []
    for part in parts:
        own = low[part]
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        packed.append(_pack([ascending(own[starts].astype(np.uint64)), packed_counts(np.diff(np.r_[starts, len(own)]))]))
    return _sent(found, packed)


def _listed(grams: np.ndarray, ids: np.ndarray, sizes: np.ndarray, places: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Memberships by bucket: low half of the n-gram, set, its size, where the n-gram lies in it."""
    order, found, parts = _cut(grams, buckets)
    low, ids, sizes, places = _low(grams[order]), ids[order], sizes[order], places[order]
    packed = [
        _pack([ascending(low[p].astype(np.uint64)), ids[p].astype("<i8").tobytes(), planes(sizes[p], 1), planes(places[p], 1)])
        for p in parts
    ]
    return _sent(found, packed)


def _low(grams: np.ndarray) -> np.ndarray:
    return (grams & np.uint64(0xFFFFFFFF)).astype("<u4")


def _code(grams: np.ndarray, buckets: int) -> np.ndarray:
    """What counts of n-grams are kept by: bucket and low half."""
    return (((grams >> np.uint64(32)) % np.uint64(buckets)) << np.uint64(32)) | (grams & np.uint64(0xFFFFFFFF))


#: Buckets below zero carry what is known of documents, in so many parts.
DESCRIBED_PARTS = 256
DESCRIBED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("set_id", pa.int64())])


def _packed_rows(batch: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as writer:
        writer.write_batch(batch)
    return out.getvalue().to_pybytes()


def _send_counted(buckets: int):
    """Codes of n-grams to be counted, and documents with the number and the hash of their n-grams."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            sizes, ids = [], []
            for text in batch.column(1):
                grams = shingles(text.as_py())
                sizes.append(len(grams))
                ids.append(set_id(grams) if len(grams) else None)
                held.append(grams)
                n += len(held[-1])
                if n >= FLUSH:
                    yield _counted(np.concatenate(held), buckets)
                    held, n = [], 0
            described = pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64())], schema=DESCRIBED)
            if len(sizes):
                part = (next((i for i in ids if i is not None), 0)) % DESCRIBED_PARTS
                yield pa.RecordBatch.from_arrays(
                    [pa.array([-1 - part], pa.int64()), pa.array([_packed_rows(described)], pa.binary())], ["bucket", "packed"]
                )
        if n:
            yield _counted(np.concatenate(held), buckets)

    return send


COUNTED = "code long, n long, described binary"


def _count(table: pa.Table) -> pa.Table:
    bucket = table["bucket"][0].as_py()
    if bucket < 0:
        none = pa.nulls(table.num_rows, pa.int64())
        return pa.table({"code": none, "n": none, "described": table["packed"].cast(pa.binary())})
    low, n = [], []
    for packed in table["packed"]:
        hashes, counts = _unpack(packed.as_py(), 2)
        low.append(from_ascending(hashes))
        n.append(counts_of(counts, len(low[-1])))
    low, n = np.concatenate(low), np.concatenate(n)
    order = np.argsort(low, kind="stable")  # parts ascend already
    low, n = low[order], n[order]
    starts = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
    counts = np.add.reduceat(n, starts)
    often = counts >= FREQUENT
    codes = (np.int64(bucket) << 32) | low[starts[often]].astype(np.int64)
    return pa.table(
        {
            "code": pa.array(codes, pa.int64()),
            "n": pa.array(counts[often].astype(np.int64), pa.int64()),
            "described": pa.nulls(len(codes), pa.binary()),
        }
    )


def _unpack_described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for packed in batch.column(0):
            yield from pa.ipc.open_stream(packed.as_py())


def frequent_grams(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ascending codes of the most frequent n-grams, and the place of each by its number of documents.

    A class of frequency is in as a whole or not at all.
    """
    step = F.floor(F.log2("n") * CLASSES).cast("int")
    sizes = counted.filter("code is not null").groupBy(step.alias("step")).count().collect()  # a row per class
    least, total = None, 0
    for row in sorted(sizes, key=lambda r: -r["step"]):
        total += row["count"]
        if total > MOST_FREQUENT:
            break
        least = row["step"]
    if least is None:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    most = counted.filter((F.col("code").isNotNull()) & (step >= least)).select("code", "n").toArrow()
    codes, n = most["code"].to_numpy().astype(np.uint64), most["n"].to_numpy()
    order = np.argsort(codes)
    codes, n = codes[order], n[order]
    ranks = np.empty(len(codes), dtype=np.int64)
    ranks[np.lexsort((codes, n))] = np.arange(len(codes))
    return codes, ranks


def in_order(grams: np.ndarray, buckets: int, codes: np.ndarray, ranks: np.ndarray, length: int) -> np.ndarray:
    """The first n-grams in the global order. ``codes`` ascend, ``ranks`` is each one's place among the frequent."""
    if not len(codes):
        return grams[:length]
    rare, last, places, n, at = [], [], [], 0, 0
    while n < length and at < len(grams):
        part = grams[at : at + length - n]
        at += len(part)
        code = _code(part, buckets)
        found = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
        frequent = codes[found] == code
        if frequent.any():
            last.append(part[frequent])
            places.append(ranks[found[frequent]])
            part = part[~frequent]
        rare.append(part)
        n += len(part)
    if n < length:
        late, place = np.concatenate(last), np.concatenate(places)
        rare.append(late[np.lexsort((late, place))][: length - n])
    return rare[0] if len(rare) == 1 else np.concatenate(rare)


def _send_prefixes(buckets: int, shared):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, ranks = shared.value
        grams_held, ids_held, sizes_held, n, seen = [], [], [], 0, set()

        def flush() -> pa.RecordBatch:
            lengths = [len(g) for g in grams_held]
            places = np.concatenate([np.arange(n) for n in lengths])
            ids, sizes = (np.repeat(np.array(x), lengths) for x in (ids_held, sizes_held))
            return _listed(np.concatenate(grams_held), ids, sizes, places, buckets)

        for batch in batches:
            for text in batch.column(0):
                grams = shingles(text.as_py())
                if not len(grams):
                    continue
                known = set_id(grams)
                if known in seen:
                    continue
                seen.add(known)
                prefix = in_order(grams, buckets, codes, ranks, prefix_length(len(grams)))
                grams_held.append(prefix)
                ids_held.append(known)
                sizes_held.append(len(grams))
                n += len(prefix)
                if n >= FLUSH:
                    yield flush()
                    grams_held, ids_held, sizes_held, n, seen = [], [], [], 0, set()
        if n:
            yield flush()

    return send


#: A membership: the set, its size, and whether it can be the smaller one of a pair in this list.
MEMBER = np.dtype([("id", "<i8"), ("n", "<u4"), ("short", "<u4")])


def largest_partner(n: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The largest size of a set that can be similar if the first n-gram in common lies here.

    What is left, n - place, has to be the overlap at least: part * (n + m) <= (part + whole) * (n - place).
    """
    part, whole = SIMILAR
    return ((part + whole) * (n - place)) // part - n


def possible_members(n: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Which members of a list, by ascending size, can be one of a similar pair that meets here first.

    A pair's smaller set is in reach of the larger one, and the other way round.
    """
    part, whole = SIMILAR
    short = most >= n
    sizes = n[short]
    least = -(-n * part // whole)
    smaller = np.searchsorted(sizes, np.minimum(n, most), side="right") - np.searchsorted(sizes, least)
    larger = np.searchsorted(n, np.minimum(most, n * whole // part), side="right") - np.searchsorted(n, n)
    # Both count the set itself.
    return (smaller > short) | (short & (larger > 1))


MADE = "list_id long, members binary, key long, part int, low long, high long, any_short boolean"


def _make_lists(table: pa.Table) -> pa.Table:
    """Lists of a bucket with two different sets or more that could be similar; long ones in blocks of ascending size."""
    import xxhash

    columns = [[], [], [], []]
    for packed in table["packed"]:
        low, ids, sizes, places = _unpack(packed.as_py(), 4)
        for column, values in zip(columns, (from_ascending(low), np.frombuffer(ids, "<i8"), from_planes(sizes), from_planes(places))):
            column.append(values)
    low, ids, sizes, places = (np.concatenate(c) for c in columns)
    sizes, places = sizes.astype(np.int64), places.astype(np.int64)
    order = np.lexsort((ids, sizes, low))
    low, ids, sizes, places = low[order], ids[order], sizes[order], places[order]
    new = np.r_[True, (low[1:] != low[:-1]) | (ids[1:] != ids[:-1])]
    low, ids, sizes, places = low[new], ids[new], sizes[new], places[new]
    most = largest_partner(sizes, places)
    starts = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
    ends = np.r_[starts[1:], len(low)]
    found: dict[int, tuple] = {}
    several = ends - starts > 1
    for s, e in zip(starts[several].tolist(), ends[several].tolist()):
        kept = s + np.flatnonzero(possible_members(sizes[s:e], most[s:e]))
        if len(kept) < 2:
            continue
        members = np.empty(len(kept), MEMBER)
        members["id"], members["n"], members["short"] = ids[kept], sizes[kept], most[kept] >= sizes[kept]
        whole = members.tobytes()
        key = xxhash.xxh3_64_intdigest(whole) - 2**63
        if len(members) <= 2 * BLOCK:
            found[key] = (whole, None, None, None, None, None)
            continue
        for part, at in enumerate(range(0, len(members), BLOCK)):
            block = members[at : at + BLOCK]
            number = xxhash.xxh3_64_intdigest(block.tobytes(), seed=part) - 2**63
            found[number] = (block.tobytes(), key, part, int(block["n"][0]), int(block["n"][-1]), bool(block["short"].any()))
    values = [list(found), *([v[k] for v in found.values()] for k in range(6))]
    types = [pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
    return pa.table([pa.array(v, t) for v, t in zip(values, types)], names=[c.split()[0] for c in MADE.split(", ")])


def _lists(made: DataFrame) -> DataFrame:
    """list_id, members: whole lists, and for each long one its blocks, alone and two by two where sizes fit."""
    once = store(made.dropDuplicates(["list_id"]), "made")
    whole = once.filter("part is null").select("list_id", "members")
    blocks = once.filter("part is not null")
    first, second = (blocks.select("key", *[F.col(c).alias(f"{c}_{k}") for c in ("part", "members", "low", "high", "any_short")]) for k in "ab")
    part, of = SIMILAR
    met = first.join(second, "key").filter("part_a <= part_b and any_short_a").filter(F.col("low_b") * part <= F.col("high_a") * of)
    alone = F.col("part_a") == F.col("part_b")
    members = F.when(alone, F.col("members_a")).otherwise(F.concat("members_a", "members_b"))
    return whole.unionByName(met.select(F.xxhash64("key", "part_a", "part_b").alias("list_id"), members.alias("members")))


def _unpacked(members: bytes) -> np.ndarray:
    return np.frombuffer(members, MEMBER)


def _pairs_table(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    one, two = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (a, b))
    both = np.unique(np.stack([np.minimum(one, two), np.maximum(one, two)], axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0], pa.int64()), pa.array(both[:, 1], pa.int64())], ["a", "b"])


def _with_one_member(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each member with the smallest one that can be the smaller of a pair, as far as sizes fit; then the next such one."""
    part, whole = SIMILAR
    for batch in batches:
        a, b = [], []
        for members in batch.column(0):
            rows = _unpacked(members.as_py())
            ids, sizes = rows["id"], rows["n"].astype(np.int64)
            short = np.flatnonzero(rows["short"])
            at = 0
            while True:
                at = np.searchsorted(short, at)
                if at == len(short):
                    break
                one = short[at]
                end = int(np.searchsorted(sizes, sizes[one] * whole // part, side="right"))
                b.append(ids[one + 1 : end])
                a.append(np.full(len(b[-1]), ids[one]))
                at = end
        yield _pairs_table(a, b)


def _columns(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Sets of a list by size: id, size, whether it can be the smaller one, its component."""
    columns = [np.array(table[c].to_pylist(), dtype=np.int64) for c in ("set_id", "n", "short", "root")]
    order = np.lexsort((columns[0], columns[1]))
    return tuple(c[order] for c in columns)


def _with_largest(turn: int):
    def pairs(table: pa.Table) -> pa.Table:
        """Pairs of each member outside a list's largest component with a few members of that one, others each turn."""
        ids, sizes, short, roots = _columns(table)
        found, counts = np.unique(roots, return_counts=True)
        inside = roots == found[counts.argmax()]
        others, largest = np.flatnonzero(~inside), np.flatnonzero(inside)
        first = (_mixed(ids[others].astype(np.uint64) + np.uint64(turn)) % np.uint64(len(largest))).astype(np.int64)
        a, b = [], []
        for k in range(min(TRIES, len(largest))):
            partner = largest[(first + k * (1 + len(largest) // TRIES)) % len(largest)]
            possible = _sizes_fit(sizes[others], sizes[partner]) & (short[np.minimum(others, partner)] == 1)
            a.append(ids[others][possible])
            b.append(ids[partner][possible])
        return pa.Table.from_batches([_pairs_table(a, b)])

    return pairs


def _unconnected(table: pa.Table) -> pa.Table:
    """All possible pairs of a list whose members are of different components."""
    part, whole = SIMILAR
    ids, sizes, short, roots = _columns(table)
    a, b = [], []
    for k in np.flatnonzero(short).tolist():
        end = int(np.searchsorted(sizes, sizes[k] * whole // part, side="right"))
        later = slice(k + 1, end)
        b.append(ids[later][roots[later] != roots[k]])
        a.append(np.full(len(b[-1]), ids[k]))
    return pa.Table.from_batches([_pairs_table(a, b)])


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for list_id, members in zip(batch.column(0).to_pylist(), batch.column(1)):
            rows = _unpacked(members.as_py())
            columns = [np.full(len(rows), list_id), rows["id"], rows["n"], rows["short"]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype(np.int64), pa.int64()) for c in columns], ["list_id", "set_id", "n", "short"]
            )


def _bits_of(ids: np.ndarray, bits: int) -> np.ndarray:
    return _mixed(ids.astype(np.uint64)) % np.uint64(bits)


def _map_bits(bits: int, per_row: int = 2**16):
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.zeros(bits, dtype=bool)
        for batch in batches:
            marked[_bits_of(batch.column(0).to_numpy(zero_copy_only=False), bits)] = True
        packed = np.packbits(marked).reshape(-1, min(per_row, bits) // 8)
        used = np.flatnonzero(packed.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array([packed[k].tobytes() for k in used], pa.binary())], ["part", "bits"]
        )

    return mark


def _join_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    joined: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, bits in zip(batch.column(0).to_pylist(), batch.column(1)):
            values = np.frombuffer(bits.as_py(), np.uint8)
            joined[part] = joined[part] | values if part in joined else values
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(joined), pa.int64()), pa.array([v.tobytes() for v in joined.values()], pa.binary())], ["part", "bits"]
    )


def _needed_map(ids: DataFrame) -> tuple[np.ndarray, int]:
    """Bit map of hashed ids, of a bounded size; a few ids too many may pass it."""
    bits = 2**16
    while bits < min(MOST_BITS, 16 * ids.count()):
        bits *= 2
    whole = np.zeros((bits // 2**16, 2**16 // 8), dtype=np.uint8)
    marked = ids.coalesce(8).mapInArrow(_map_bits(bits), "part long, bits binary")
    for row in marked.repartition("part").mapInArrow(_join_bits, "part long, bits binary").collect():
        whole[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    return whole.ravel(), bits


def _grams_of_needed(shared):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        needed, bits = shared.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            at = _bits_of(ids, bits)
            passes = (needed[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1
            kept, sets, packed = [], [], []
            for k in np.flatnonzero(passes).tolist():
                grams = shingles(batch.column(1)[k].as_py())
                if len(grams):
                    kept.append(int(ids[k]))
                    sets.append(set_id(grams))
                    packed.append(grams.astype("<u8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(kept, pa.int64()), pa.array(sets, pa.int64()), pa.array(packed, pa.binary())], ["doc_id", "b", "grams"]
            )

    return send


def global_places(grams: np.ndarray, buckets: int, codes: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """A number per n-gram that puts them in the global order, the most frequent first."""
    rare = (grams >> np.uint64(1)) | np.uint64(2**63)
    if not len(codes):
        return rare
    code = _code(grams, buckets)
    found = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
    return np.where(codes[found] == code, (len(codes) - ranks[found]).astype(np.uint64), rare)


def trie_matches(x: np.ndarray, others: list[np.ndarray], place_of) -> list[int]:
    """Which of the sets are similar to x.

    Sets are put in the global order and sorted, so that those with a common beginning follow each other: a path of
    the trie. ``overlap[d]`` is the overlap with x after d n-grams of the path; a set starts where it leaves the one
    before. A set ends where what is left of it and of x cannot reach the overlap it needs; where that fails for
    the least overlap that any set of fitting size needs, all sets below are left out.
    """
    part, whole = SIMILAR
    members = np.sort(x)
    places_of_x = np.sort(place_of(x))
    ordered, keys = [], []
    for y in others:
        places = place_of(y)
        order = np.lexsort((y, places))
        ordered.append(y[order])
        keys.append(places[order])
    least = least_overlap(len(x), -(-len(x) * part // whole))
    found, overlap = [], np.zeros(1, dtype=np.int64)
    before, walked, closed = np.empty(0, np.uint64), 0, -1
    for k in sorted(range(len(ordered)), key=lambda k: (keys[k].astype(">u8").tobytes(), ordered[k].astype(">u8").tobytes())):
        y = ordered[k]
        n = min(len(before), len(y), walked)
        differ = np.flatnonzero(before[:n] != y[:n])
        depth = int(differ[0]) if len(differ) else n
        if 0 <= closed <= depth:
            continue  # below a node that no set can pass
        closed = -1
        need = least_overlap(len(x), len(y))
        parts, shared = [overlap[: depth + 1]], int(overlap[depth])
        while True:
            # Of x, what comes after the path or stands with its end.
            left = len(x) - (int(np.searchsorted(places_of_x, keys[k][depth - 1])) if depth else 0)
            if shared + left < least:
                closed = depth
                break
            if depth == len(y) or shared + min(len(y) - depth, left) < need:
                break
            step = y[depth : depth + 128]
            at = np.minimum(np.searchsorted(members, step), len(members) - 1)
            parts.append(shared + np.cumsum(members[at] == step))
            shared, depth = int(parts[-1][-1]), depth + len(step)
        before, overlap, walked = y, np.concatenate(parts), depth
        if depth == len(y) and shared >= need:
            found.append(k)
    return found


def _verify(buckets: int, shared):
    def verify(table: pa.Table) -> pa.Table:
        a, b = table["a"].to_pylist(), table["b"].to_pylist()
        sets = [np.frombuffer(g.as_py(), dtype="<u8") for g in table["grams"]]
        own = next(k for k in range(len(a)) if a[k] == b[k])
        rest = [k for k in range(len(a)) if a[k] != b[k]]

        def place_of(grams: np.ndarray) -> np.ndarray:
            return global_places(grams, buckets, *shared.value)

        found = [rest[k] for k in trie_matches(sets[own], [sets[k] for k in rest], place_of)]
        return pa.table({"a": pa.array([a[k] for k in found], pa.int64()), "b": pa.array([b[k] for k in found], pa.int64())})

    return verify


def _verified(pairs: DataFrame, needed: DataFrame, grams: DataFrame, verify) -> DataFrame:
    """The pairs (a, b) whose sets are similar. A set with many partners meets them in several pieces.

    ``needed`` has the document that stands for a set, ``grams`` the n-grams by document, and of some more.
    """
    counts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).cast("int").alias("pieces"))
    counts = store(counts, "counts")
    dealt = pairs.join(counts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("pieces")).alias("piece"))
    own = counts.select("a", F.col("a").alias("b"), F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
    asked = dealt.unionByName(own.withColumn("piece", F.col("piece").cast("long")))
    asked = asked.join(needed.select(F.col("set_id").alias("b"), "doc_id"), "b").join(grams, ["doc_id", "b"])
    return store(asked.groupBy("a", "piece").applyInArrow(verify, "a long, b long"), "links")


def _linked_sets(texts: DataFrame, sets: DataFrame, counted: DataFrame, buckets: int) -> DataFrame:
    """node, component of the sets that have a link."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(frequent_grams(counted))  # MOST_FREQUENT numbers at most
    sent = texts.select("text").mapInArrow(_send_prefixes(buckets, shared), "bucket long, packed binary")
    lists = store(_lists(sent.groupBy("bucket").applyInArrow(_make_lists, MADE)), "lists")
    members = store(lists.mapInArrow(_members, "list_id long, set_id long, n long, short long"), "members")
    verify = _verify(buckets, shared)

    first_doc = sets.filter("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("doc_id"))
    needed = store(first_doc.join(members.select("set_id").distinct(), "set_id"), "needed")
    bit_map = spark.sparkContext.broadcast(_needed_map(needed.select("doc_id")))
    grams = texts.filter("doc_id is not null").select("doc_id", "text").mapInArrow(
        _grams_of_needed(bit_map), "doc_id long, b long, grams binary"
    )
    grams = store(grams, "grams")

    stars = store(lists.select("members").mapInArrow(_with_one_member, "a long, b long").distinct(), "stars")
    links = _verified(stars, needed, grams, verify)
    tested, roots = stars, store(components(links), "roots")
    for choose in (*map(_with_largest, range(TURNS)), _unconnected):
        rooted = members.join(roots, members["set_id"] == roots["node"], "left")
        rooted = store(rooted.select("list_id", "set_id", "n", "short", F.coalesce("component", "set_id").alias("root")), "rooted")
        open_lists = rooted.groupBy("list_id").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        open_lists = open_lists.filter("low < high").select("list_id")
        rest = rooted.join(open_lists, "list_id").groupBy("list_id").applyInArrow(choose, "a long, b long")
        rest = store(rest.distinct().join(tested, ["a", "b"], "left_anti"), "rest")
        if not rest.isEmpty():
            tested = tested.unionByName(rest)
            links = links.unionByName(_verified(rest, needed, grams, verify))
            roots = store(components(links), "roots")
    return roots


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links).

    Components are given, not links: pairs that others connect already are not compared, and links are not counted.
    A document without words, or with a null text, has no shingles and links with nothing. Rows without an id
    have no component and link with nothing; rows that repeat an id are linked as their texts are. Columns
    other than doc_id and text are ignored; an empty table gives an empty result.
    """
    ship_code(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, n_bytes // PER_BUCKET)
    sent = texts.mapInArrow(_send_counted(buckets), "bucket long, packed binary")
    counted = store(sent.groupBy("bucket").applyInArrow(_count, COUNTED), "counted")
    described = counted.filter("described is not null").select("described")
    described = described.mapInArrow(_unpack_described, "doc_id long, n long, set_id long")
    sets = store(described.withColumn("set_id", F.when(F.col("doc_id").isNotNull(), F.col("set_id"))), "sets")
    linked = _linked_sets(texts, sets, counted, buckets)
    # Components of sets become components of documents: by the smallest id of any set in them.
    smallest = sets.filter("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("first"))
    of_set = smallest.join(linked, smallest["set_id"] == linked["node"], "left")
    of_set = store(of_set.select("set_id", "first", F.coalesce("component", "set_id").alias("root")), "of-set")
    of_root = store(of_set.groupBy("root").agg(F.min("first").alias("component_id")), "of-root")
    by_set = store(of_set.join(of_root, "root").select("set_id", "component_id"), "by-set")
    joined = sets.join(by_set, "set_id", "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
