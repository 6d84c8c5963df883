"""Where a pattern matches, as column expressions.

Splitting a text at a pattern and extracting its matches give the same leftmost, non-overlapping matches, so the
lengths of pieces and matches in turn are the positions. Lengths count code points. Positions are running sums over
arrays; they and the comparison of two lists of spans take time in proportion to the number of matches, times its
logarithm.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "struct<start:bigint,end:bigint,hit:string,before:string,after:string>"
_LAYOUT = "\t\n\x0b\x0c\r"


def _plain(text: Column) -> Column:
    return F.lower(F.translate(text, _LAYOUT, " " * len(_LAYOUT)))


def _last_word(text: Column) -> Column:
    return F.substring_index(F.rtrim(_plain(text)), " ", -1)


def _first_word(text: Column) -> Column:
    return F.substring_index(F.ltrim(_plain(text)), " ", 1)


def _running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """What ``combine`` makes of an array of numbers, none below 0, up to each place.

    Each pass combines every place with the one 1, 2, 4 … before it, so that the passes are as many as the length has
    binary digits. Appending to an array for each element would copy it each time.
    """

    def further(done: Column, k: Column) -> Column:
        shift = F.pow(F.lit(2), k).cast("int")
        earlier = F.concat(F.array_repeat(F.lit(0).cast("bigint"), shift), F.slice(done, 1, F.size(done) - shift))
        return F.zip_with(done, earlier, combine)

    passes = F.sequence(F.lit(0), F.ceil(F.log2(F.size(values))).cast("int") - 1)
    return F.when(F.size(values) > 1, F.aggregate(passes, values, further)).otherwise(values)


def _located(df: DataFrame, name: str, context: bool) -> Column:
    """The spans of the hits and gaps in columns of ``df``."""
    hits, gaps = F.col(f"__hits_{name}"), F.col(f"__gaps_{name}")
    none = F.lit(None).cast("string")
    parts = F.arrays_zip(
        F.col(f"__ends_{name}").alias("end"), hits.alias("hit"), F.slice(gaps, 1, F.size(hits)).alias("gap"), F.slice(gaps, 2, F.size(hits)).alias("next")
    )

    def span(p: Column) -> Column:
        return F.struct(
            (p["end"] - F.char_length(p["hit"])).alias("start"),
            p["end"].alias("end"),
            p["hit"].alias("hit"),
            (_last_word(p["gap"]) if context else none).alias("before"),
            (_first_word(p["next"]) if context else none).alias("after"),
        )

    return F.transform(parts, span)


def with_spans(df: DataFrame, text: str, patterns: dict[str, str], context: bool = False) -> DataFrame:
    """Add, per name, the array of matches of its pattern: start, end, hit and, if asked, the words around."""
    for name, pattern in patterns.items():
        df = df.withColumn(f"__hits_{name}", F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))
    none = F.array().cast("array<string>")
    for name, pattern in patterns.items():
        some = F.size(f"__hits_{name}") > 0
        df = df.withColumn(f"__gaps_{name}", F.when(some, F.split(F.col(text), pattern, -1)).otherwise(none))
    for name in patterns:
        hits = F.col(f"__hits_{name}")
        lengths = F.zip_with(
            F.slice(f"__gaps_{name}", 1, F.size(hits)), hits, lambda g, h: (F.char_length(g) + F.char_length(h)).cast("bigint")
        )
        df = df.withColumn(f"__lengths_{name}", lengths)
    for name in patterns:
        df = df.withColumn(f"__ends_{name}", _running(F.col(f"__lengths_{name}"), lambda a, b: a + b))
    nothing = F.array().cast(f"array<{SPAN}>")
    for name in patterns:
        df = df.withColumn(name, F.when(F.size(f"__hits_{name}") > 0, _located(df, name, context)).otherwise(nothing))
    return df.drop(*[f"__{what}_{name}" for what in ("hits", "gaps", "lengths", "ends") for name in patterns])


def labelled(kinds: Sequence[str]) -> Column:
    """The spans of all kinds, by start, then by the order of kinds: (start, rank, end, kind)."""

    def of_kind(rank: int, kind: str) -> Column:
        return F.transform(
            kind,
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")
            ),
        )

    parts = [of_kind(rank, kind) for rank, kind in enumerate(kinds)]
    return F.array_sort(F.concat(*parts))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def apart(df: DataFrame, name: str, others: Column) -> DataFrame:
    """``df`` with only those spans of a column that overlap none of the others.

    The column's spans ascend and do not overlap each other. All are put in one order, others at their start and spans
    at their end: a span overlaps if one that starts before its end reaches beyond its start.
    """

    def mark(at: Column, is_other: int, low: Column, reach: Column) -> Column:
        columns = {"at": at, "other": F.lit(is_other), "low": low, "reach": reach}
        return F.struct(*[(c if k == "other" else c.cast("bigint")).alias(k) for k, c in columns.items()])

    nothing = F.lit(0)
    marks = F.concat(
        F.transform(name, lambda s: mark(s["end"], 0, s["start"], nothing)),
        F.transform("__others", lambda o: mark(o["start"], 1, nothing, o["end"])),
    )
    df = df.withColumn("__others", others).withColumn("__both", (F.size(name) > 0) & (F.size("__others") > 0))
    df = df.withColumn("__marks", F.when(F.col("__both"), F.array_sort(marks)))
    df = df.withColumn("__reach", F.transform("__marks", lambda m: m["reach"]))
    df = df.withColumn("__reach", F.when(F.col("__both"), _running(F.col("__reach"), lambda a, b: F.greatest(a, b))))
    free = F.zip_with("__marks", "__reach", lambda m, r: F.when(m["other"] == 0, r <= m["low"]))
    df = df.withColumn("__free", F.filter(free, lambda f: f.isNotNull()))
    pairs = F.zip_with(name, "__free", lambda s, f: F.struct(s.alias("span"), f.alias("free")))
    kept = F.transform(F.filter(pairs, lambda p: p["free"]), lambda p: p["span"])
    df = df.withColumn(name, F.when(F.col("__both"), kept).otherwise(F.col(name)))
    return df.drop("__others", "__both", "__marks", "__reach", "__free")


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
