"""Spelling variants: words one edit apart, found by asymmetric q-chunks, and the frequent form of each.

Of two words x and y, y as long or one longer, x contributes two disjoint chunks, its halves, and y its positional
grams of their lengths. One edit leaves a half of x unchanged: the first one at its place in y, the second one
shifted by the difference in length, zero or one. So words meet where a chunk equals a gram within that shift, and the
pair is verified. Grams at other places cannot be a chunk's partner and are not sent.

Chunks that very many words share are cut further: there the rests of both words, which must be one edit apart, meet
where they are equal without one code point. No group is compared pair by pair then, and no pair is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playthrough.llm.common import ascii_lower, store, text_or_empty

RUN = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: A run loses a code point if this divides its hash.
DAMAGED = 97
#: A form occurs so many times as often as the word, at least.
MORE_OFTEN = 2
#: Words that share a chunk, at most, for their pairs to be verified one by one.
CROWDED = 64


def words(docs: DataFrame) -> DataFrame:
    """word, n: the distinct runs, some without one code point, that are long and frequent enough."""
    runs = F.explode(F.regexp_extract_all(ascii_lower(text_or_empty()), F.lit(RUN), F.lit(0)))
    found = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), runs.alias("run"))
    found = found.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    length = F.char_length("run")
    at = F.pmod(F.col("h"), length.cast("long")).cast("int")
    damaged = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2, length))
    found = found.select(F.when(F.col("h") % DAMAGED == 0, damaged).otherwise(F.col("run")).alias("word"))
    counted = found.filter(F.char_length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= LEAST_COUNT)


def _piece(of: Column, chunk: Column, rest: Column, longer: Column, part: int) -> Column:
    """Where words meet: the chunk's owner's length and part, the difference in length, the chunk; and what is left."""
    return F.struct(
        of.alias("length"), F.lit(part).alias("part"), longer.alias("longer"), chunk.alias("chunk"), rest.alias("rest")
    )


def _pieces(table: DataFrame, of: Column, longer: Column, name: str) -> DataFrame:
    """Both pieces of each word in the role of a partner of words of length ``of``."""
    word, half = F.col("word"), F.floor(of / 2).cast("int")
    length = F.char_length("word")
    split_at = half + longer
    first = _piece(of, F.substr(word, F.lit(1), half), F.substr(word, half + 1, length), longer, 0)
    second = _piece(of, F.substr(word, split_at + 1, length), F.substr(word, F.lit(1), split_at), longer, 1)
    return table.select(word.alias(name), F.col("n").alias(f"{name}_n"), F.inline(F.array(first, second)))


KEY = ["length", "part", "longer", "chunk"]


def _without_one(rest: Column) -> Column:
    """(place, rest without the code point there) for each place."""
    n = F.char_length(rest)
    return F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.struct(i.alias("place"), F.concat(F.substr(rest, F.lit(1), i - 1), F.substr(rest, i + 1, n)).alias("left")),
    )


def _meeting(side: DataFrame, chunks: bool) -> DataFrame:
    """Rows by the rest without one code point: of equal lengths by its place too, else only the longer word lacks one."""
    whole = F.array(F.struct(F.lit(0).alias("place"), F.col("rest").alias("left")))
    less = _without_one(F.col("rest"))
    anywhere = F.array_distinct(F.transform(less, lambda s: F.struct(F.lit(0).alias("place"), s["left"].alias("left"))))
    options = F.when(F.col("longer") == 0, less).otherwise(whole if chunks else anywhere)
    return side.select("*", F.inline(options))


def near_pairs(table: DataFrame) -> DataFrame:
    """x, x_n, y, y_n: every pair of words exactly one edit apart, once; y is the longer or the larger one."""
    length = F.char_length("word")
    zero, one = F.lit(0), F.lit(1)
    chunks = _pieces(table, length, zero, "x").unionByName(
        # The same chunks wait for words that are one longer.
        _pieces(table, length, zero, "x").withColumn("longer", one)
    )
    grams = _pieces(table, length, zero, "y").unionByName(
        _pieces(table.filter(length > LEAST_LENGTH), length - 1, one, "y")
    )
    crowded = chunks.groupBy(*KEY).agg(F.count(one).alias("members")).filter(F.col("members") > CROWDED)
    crowded = store(crowded.select(*KEY, F.lit(True).alias("crowded")), "crowded")
    chunks, grams = (side.join(crowded, KEY, "left").withColumn("crowded", F.col("crowded").isNotNull()) for side in (chunks, grams))

    ordered = (F.col("longer") == 1) | (F.col("x") < F.col("y"))
    even = chunks.filter("not crowded").drop("rest").join(grams.filter("not crowded").drop("rest"), KEY).filter(ordered)
    even = even.filter(F.levenshtein("x", "y", 1) == 1)
    rest = [*KEY, "place", "left"]
    dense = _meeting(chunks.filter("crowded"), True).join(_meeting(grams.filter("crowded"), False).drop("rest"), rest)
    dense = dense.filter(ordered & (F.levenshtein("x", "y", 1) == 1))
    columns = ["x", "x_n", "y", "y_n"]
    return even.select(*columns).unionByName(dense.select(*columns)).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: forms followed to the last. Each round doubles the steps, as n doubles with every step."""
    now = store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("via"), F.col("root").alias("beyond"))
        step = now.join(onward, now["root"] == onward["via"], "left")
        step = store(step.select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("on")), "roots")
        now = step.select("word", "root")
        if step.filter("on").isEmpty():
            return now


def variants(docs: DataFrame) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    The form is the near word that occurs most, the smallest in code-point order of equally frequent ones, if it
    occurs ``MORE_OFTEN`` times as often as the word. A null text has no words; a null id counts as empty in the hash;
    rows that repeat an id are read like any others. Columns other than doc_id and text are ignored; an empty table
    gives an empty result.
    """
    table = store(words(docs), "words")
    pairs = store(near_pairs(table), "near")
    best = F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near").alias("near"))).alias("best")
    both = pairs.selectExpr("x AS word", "y AS near", "y_n AS near_n").unionByName(
        pairs.selectExpr("y AS word", "x AS near", "x_n AS near_n")
    )
    linked = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    known = table.join(linked, "word", "left")
    more_often = -F.col("best.order") >= MORE_OFTEN * F.col("n")
    known = known.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(more_often, F.col("best.near")).alias("form"),
        F.when(more_often, -F.col("best.order")).alias("form_n"),
    )
    known = store(known, "forms")
    roots = _roots(known.filter("form is not null"))
    joined = known.join(roots, "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
