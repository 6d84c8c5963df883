"""Cutting hot keys into consecutive chunks of time.

A window over one key runs in one task, so a title or user holding a third of all events would
hold up the whole job. ``find_splits`` looks for such keys and cuts their rows, in
``(event_ts, event_id)`` order, into chunks of about ``chunk_rows`` rows; every other key stays
whole. ``history.keyed_history`` then windows inside the chunks and adds what the earlier chunks
carry over, which gives the same rows as one window per key.

Rows that share a key *and* a timestamp belong to one chunk, so that strict ``<`` frames never
need to look at a neighbour for ties. When that one timestamp alone is too large it gets a chunk
of its own, cut further by ``event_id`` into ``sub`` chunks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playthrough.sources.checkpoint import stored

CHUNK_ROWS = 4_000_000  # rows a single task should window over
SAMPLES_PER_CHUNK = 8
THINNED_TO = 50  # candidates per sample
BLOCK = 64  # chunk starts that are looked up in one step

CHUNK, SUB, HOT, LAST_TS = "_chunk", "_sub", "_hot", "_last_ts"


@dataclass(frozen=True)
class KeySplits:
    """Chunk starts of the hot keys; ``table`` is None when no key is hot.

    The table has one row per hot key, and a key is hot with more than a chunk's rows. Starts are looked up as in a
    tree: a key's row holds at most ``BLOCK`` of them, each the first of a node of ``nodes[0]``, whose rows hold at
    most ``BLOCK`` as well, down to the last level, which has all. No row grows with the number of a key's chunks.
    All are stored, so that the planner knows their size: it broadcasts small ones and shuffles large ones.
    """

    keys: tuple[str, ...]
    table: DataFrame | None = None
    chunk_rows: int = CHUNK_ROWS
    nodes: tuple[DataFrame, ...] = ()

    @property
    def any_hot(self) -> bool:
        return self.table is not None

    def assign(self, df: DataFrame, at: Column, row_id: Column) -> DataFrame:
        """Add the chunk and sub-chunk of every row; 0 and 0 for keys that are not hot."""
        if self.table is None:
            raise ValueError("no hot keys: use plain windows")
        row_id = F.coalesce(row_id, F.lit(""))
        here = F.size(F.filter("_blocks", lambda s: (s["ts"] < at) | ((s["ts"] == at) & (s["id"] <= row_id))))
        rows = df.join(self.table, list(self.keys), "left").withColumn(HOT, F.col(LAST_TS).isNotNull())
        rows = rows.withColumn("_place", F.when(here > 0, here - 1))
        for k, level in enumerate(self.nodes, 1):
            rows = rows.drop("_blocks", "_node").withColumnRenamed("_place", "_node")
            rows = rows.join(level, [*self.keys, "_node"], "left").withColumn("_place", F.when(here > 0, here - 1))
            if k < len(self.nodes):
                rows = rows.withColumn("_place", F.col("_node") * BLOCK + F.col("_place"))
        start = F.get("_blocks", F.col("_place"))
        return rows.withColumns(
            {CHUNK: F.coalesce(start[CHUNK], F.lit(0)), SUB: F.coalesce(start[SUB], F.lit(0))}
        ).drop("_blocks", "_id_starts", "_salts", "_place", "_node")

    def cluster(self, df: DataFrame) -> DataFrame:
        """Shuffle by key and chunk.

        Said explicitly because an input already hashed by the key alone satisfies a window's
        distribution, and would leave all chunks of a hot key in one task. The number is said as well: merged to about
        one task per core, chunks would leave most cores idle behind the last few tasks.
        """
        return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *self.keys, CHUNK, SUB)

    def salts(self) -> DataFrame | None:
        """Hot keys with the number of salt values a join should spread them over."""
        return None if self.table is None else self.table.select(*self.keys, "_salts")


def hot_keys(rows: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """Keys with more than ``limit`` rows; at most rows / limit of them."""
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.max("event_ts").alias(LAST_TS))
    return sizes.filter(F.col("_rows") > limit)


def find_splits(
    rows: DataFrame,
    keys: Sequence[str],
    *,
    reach: int | None = None,
    chunk_rows: int = CHUNK_ROWS,
    n_rows: int | None = None,
) -> KeySplits:
    """Find hot keys of ``rows`` and cut them.

    ``rows`` may hold more than what will be windowed later (raw instead of cleaned events, say):
    any cut is correct, the counts only steer the balance. ``reach`` is the length of a sliding
    frame: such rows also act at ``event_ts + reach``, so both times are balanced.

    One count, one partially aggregated count per key and, only if a key is hot, one pass over the
    rows of hot keys and a few small tables of their starts.
    """
    keys = tuple(keys)
    n = rows.count() if n_rows is None else n_rows
    limit = chunk_rows
    if n <= limit:
        return KeySplits(keys)

    rows = rows.select(*keys, "event_ts", "event_id").dropna()
    times = F.array("event_ts") if reach is None else F.array("event_ts", F.col("event_ts") + reach)
    weight = 1 if reach is None else 2
    points = F.ceil(F.col("_rows") * weight / limit) * SAMPLES_PER_CHUNK
    timeline = rows.join(hot_keys(rows, keys, limit), list(keys)).select(
        *keys, "event_id", "event_ts", LAST_TS, points.cast("bigint").alias("_points"), F.explode(times).alias("_at")
    )
    timeline = timeline.filter((F.col("_at") == F.col("event_ts")) | (F.col("_at") < F.col(LAST_TS)))
    # A uniform sample by hashing: thin out by one hash, then each slot of another keeps the row with
    # the largest. Map-side combine leaves one row per slot and map task.
    step = max(1, limit // (THINNED_TO * SAMPLES_PER_CHUNK))
    thin = timeline.filter(F.pmod(F.xxhash64(F.lit("thin"), "event_id", "_at"), F.lit(step)) == 0)
    point = F.struct(F.col("_at").alias("ts"), F.col("event_id").alias("id"))
    sample = (
        thin.withColumn("_slot", F.pmod(F.xxhash64("event_id", "_at"), F.col("_points")))
        .groupBy(*keys, "_slot")
        .agg(
            F.max_by(point, F.xxhash64(F.lit("pick"), "event_id", "_at")).alias("_point"),
            F.first(LAST_TS).alias(LAST_TS),
            F.first("_points").alias("_points"),
        )
    )
    per_key = Window.partitionBy(*keys)
    places = sample.withColumn("_i", F.row_number().over(per_key.orderBy("_point.ts", "_point.id")) - 1)
    places = stored(places.filter(F.col("_i") % SAMPLES_PER_CHUNK == 0).drop("_slot"))
    hot = places.filter(F.col("_i") == 0).select(
        *keys, LAST_TS, (F.col("_points") / SAMPLES_PER_CHUNK).cast("int").alias("_salts")
    )
    starts = stored(_starts(places.filter(F.col("_i") > 0).select(*keys, "_point.*"), keys))
    most = starts.agg(F.max("_rank")).first()[0]
    levels = []
    width = 1
    while True:
        first = _nodes(starts, keys, width)
        if most is None or most < width * BLOCK:
            break
        levels.insert(0, stored(first))
        width *= BLOCK
    moments = starts.groupBy(*keys).agg(F.count_if(F.col(SUB) > 0).alias("_id_starts"))
    table = stored(hot.join(first.drop("_node"), list(keys), "left").join(moments, list(keys), "left"))
    return KeySplits(keys) if table.isEmpty() else KeySplits(keys, table, chunk_rows, tuple(levels))


def _starts(cuts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Starts of chunks and sub-chunks from the cuts of all keys, numbered in order.

    A chunk starts at a moment, and a moment with two cuts or more is a chunk, with a sub-chunk from each id on.
    """
    moments = cuts.groupBy(*keys, "ts").agg(F.count(F.lit(1)).alias("_n"), F.collect_set("id").alias("_ids"))
    start = lambda ts, id, opens: F.struct(ts.alias("ts"), id.alias("id"), F.lit(opens).alias("_opens"))
    ts, begin = F.col("ts"), F.lit("")
    inside = F.transform("_ids", lambda id: start(ts, id, 0))
    heavy = F.concat(F.array(start(ts, begin, 1), start(ts + 1, begin, 1)), inside)
    rows = moments.select(*keys, F.inline(F.when(F.col("_n") > 1, heavy).otherwise(F.array(start(ts, begin, 1)))))
    rows = rows.groupBy(*keys, "ts", "id").agg(F.max("_opens").alias("_opens"))
    in_order = Window.partitionBy(*keys).orderBy("ts", "id")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_rank", F.row_number().over(in_order) - 1)
    opened = F.max(F.when(F.col("_opens") == 1, F.col("_rank"))).over(so_far)
    return rows.select(
        *keys,
        "ts",
        "id",
        "_rank",
        F.sum("_opens").over(so_far).cast("int").alias(CHUNK),
        (F.col("_rank") - opened).alias(SUB),
    )


def _nodes(starts: DataFrame, keys: Sequence[str], width: int) -> DataFrame:
    """Every ``width``-th start of a key, by ``BLOCK`` of these in a row."""
    node = F.floor(F.col("_rank") / (width * BLOCK)).cast("int").alias("_node")
    blocks = F.sort_array(F.collect_list(F.struct("ts", "id", CHUNK, SUB))).alias("_blocks")
    return starts.filter(F.col("_rank") % width == 0).groupBy(*keys, node).agg(blocks)


def before_chunk(keys: Sequence[str]) -> Window:
    """Earlier chunks of the same key (sub-chunks of one chunk share a timestamp)."""
    return Window.partitionBy(*keys).orderBy(CHUNK).rangeBetween(Window.unboundedPreceding, -1)


def before_sub(keys: Sequence[str]) -> Window:
    """Earlier chunks and sub-chunks of the same key."""
    return Window.partitionBy(*keys).orderBy(CHUNK, SUB).rowsBetween(Window.unboundedPreceding, -1)


def join_dimension(events: DataFrame, dim: DataFrame, key: str, splits: KeySplits | None = None) -> DataFrame:
    """Inner equi join to a table with unique ``key``.

    No broadcast hint: the planner broadcasts the dimension when its known size is below
    ``spark.sql.autoBroadcastJoinThreshold``, and shuffles it otherwise. For the shuffled case hot
    keys are salted: their few dimension rows are repeated once per salt.
    """
    salts = splits.salts() if splits is not None else None
    if salts is None:
        return events.join(dim, key)
    width = F.coalesce("_salts", F.lit(1))
    left = events.join(salts, key, "left").withColumn("_salt", F.pmod(F.xxhash64("event_id"), width).cast("int"))
    right = dim.join(salts, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), width - 1)))
    return left.drop("_salts").join(right.drop("_salts"), [key, "_salt"]).drop("_salt")
