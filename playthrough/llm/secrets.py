"""Secrets in texts: fixed patterns, and long tokens that pass for random.

A candidate is a run of encoding characters with letters and digits. Its encoding follows from the characters it
uses. Under the hypothesis that its symbols are random, three tests are made: chi-squared for the uniformity of
the alphabet, runs above and below its middle, and the correlation of neighbours. The least p-value, times
three, is the candidate's. Within each class of lengths, candidates that are not random are rejected with
a controlled false-discovery rate, so that short tokens, where the tests see little, do not lend long ones their
limit. What is not rejected is a secret of kind ``random``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playthrough.llm.common import store, text_or_empty
from playthrough.llm.spans import apart, count_of, labelled, with_spans, written

_VALUE = "[A-Za-z0-9+/_.=-]"
#: Fixed patterns. Runs too short to count cannot match; an assignment is checked afterwards, since what it
#: takes up is not searched again.
PATTERNS = {
    "assign": rf"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?({_VALUE}+)""",
    "access": "AKIA[A-Z0-9]{16,}",
    "hex": "[0-9a-f]{24,}",
}
LEAST_ASSIGNED = 6
CANDIDATE = "(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}+"
#: Encoding: what its tokens look like, and its alphabet in order. The first that fits counts.
ENCODINGS = (
    ("^[0-9a-f]+$", "0123456789abcdef"),
    ("^[0-9A-F]+$", "0123456789ABCDEF"),
    ("^[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("^[0-9a-z]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("^[0-9A-Z]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("^[^+/]*[_-][^+/]*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
    ("[_-]", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_+/"),
    ("", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
)
FALSE_DISCOVERY_RATE = 0.05
#: p-values are kept as steps of -10 log10, up to this.
MOST_STEPS = 200


def _tail(z: Column) -> Column:
    """Share of a normal variable above z, to about 0.0002."""
    return 1 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z))


def randomness_p(token: Column) -> Column:
    """p-value of the three tests for random symbols of the token's own encoding."""
    alphabet = F.lit(ENCODINGS[-1][1])
    for shape, letters in reversed(ENCODINGS[:-1]):
        alphabet = F.when(token.rlike(shape), F.lit(letters)).otherwise(alphabet)
    letters = F.split(F.regexp_replace(token, "=+$", ""), "")
    symbols = F.transform(letters, lambda c: (F.position(c, alphabet) - 1).cast("double"))
    case = F.struct(symbols.alias("x"), F.char_length(alphabet).cast("double").alias("k"))

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)

    def battery(c: Column) -> Column:
        x, k = c["x"], c["k"]
        n = F.size(x).cast("double")
        squares = total(
            F.transform(F.array_distinct(x), lambda s: F.pow(F.size(F.filter(x, lambda v: v == s)).cast("double"), F.lit(2.0)))
        )
        df = k - 1
        chi = F.greatest(k / n * squares - n, F.lit(0.0))
        part = 2 / (9 * df)
        uniform = (F.pow(chi / df, F.lit(1 / 3)) - (1 - part)) / F.sqrt(part)

        high = F.transform(x, lambda v: F.when(v > (k - 1) / 2, 1.0).otherwise(0.0))
        turns = F.zip_with(F.slice(high, 2, F.size(x)), F.slice(high, 1, F.size(x) - 1), lambda a, b: F.abs(a - b))
        above = total(high)
        mean = 2 * above * (n - above) / n + 1
        spread = F.sqrt(F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(0.0)))
        runs = F.when(spread > 0, F.abs(total(turns) + 1 - mean) / spread).otherwise(F.lit(9.0))

        middle = total(x) / n
        around = F.transform(x, lambda v: v - middle)
        products = F.zip_with(F.slice(around, 2, F.size(x)), F.slice(around, 1, F.size(x) - 1), lambda a, b: a * b)
        energy = total(F.transform(around, lambda v: v * v))
        serial = F.when(energy > 0, F.abs(total(products) / energy + 1 / n) * F.sqrt(n)).otherwise(F.lit(9.0))
        least = F.least(_tail(uniform), 2 * _tail(runs), 2 * _tail(serial))
        return F.least(3 * least, F.lit(1.0))

    return F.transform(F.array(case), battery)[0]


def _length_class(length: Column) -> Column:
    return F.floor(F.log2(length)).cast("int")


def rejection_limits(found: DataFrame, rate: float = FALSE_DISCOVERY_RATE) -> DataFrame:
    """length_class, limit: from how many steps on candidates are rejected (Benjamini-Hochberg over steps).

    All candidates with letters and digits count; what is shuffled is a count per class and step.
    """
    one = found.select(F.explode("candidates").alias("c")).select("c.length_class", "c.step")
    counts = one.groupBy("length_class", "step").agg(F.count(F.lit(1)).alias("n"))
    from_here = Window.partitionBy("length_class").orderBy(F.col("step").desc())
    rank, of = F.sum("n").over(from_here), F.sum("n").over(Window.partitionBy("length_class"))
    steps = counts.select("length_class", "step", rank.alias("rank"), of.alias("of"))
    worst = F.pow(F.lit(10.0), -F.col("step") / 10)
    return steps.filter(worst <= rate * F.col("rank") / F.col("of")).groupBy("length_class").agg(F.min("step").alias("limit"))


def find_secrets(docs: DataFrame, rate: float = FALSE_DISCOVERY_RATE) -> DataFrame:
    """One row per document: doc_id, base and all_spans (arrays of start, rank, end, kind; code points).

    A null or empty text has none. Rows with null or repeated ids are rows of their own. Columns other than
    doc_id and text are ignored; an empty table gives an empty result.
    """
    read = docs.select("doc_id", text_or_empty().alias("text"))
    found = with_spans(read, "text", PATTERNS | {"candidate": CANDIDATE})
    value = F.regexp_extract
    found = found.withColumn(
        "assign",
        F.filter("assign", lambda s: F.char_length(value(s["hit"], PATTERNS["assign"], 1)) >= LEAST_ASSIGNED),
    )
    found = found.withColumn("base", labelled(list(PATTERNS)))
    mixed = F.filter("candidate", lambda s: s["hit"].rlike("[0-9]") & s["hit"].rlike("[A-Za-z]"))
    found = apart(found.withColumn("candidate", mixed), "candidate", F.col("base"))

    def tested(s: Column) -> Column:
        p = F.greatest(randomness_p(s["hit"]), F.lit(1e-30))
        return F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            _length_class(F.char_length(s["hit"])).alias("length_class"),
            F.least(F.floor(-10 * F.log10(p)), F.lit(MOST_STEPS)).cast("int").alias("step"),
        )

    found = store(found.select("doc_id", "base", F.transform("candidate", tested).alias("candidates")), "secrets")
    limits = rejection_limits(found, rate).collect()  # a row per power of two of a length
    def kept(c: Column) -> Column:
        of_class = F.lit(MOST_STEPS + 1)
        for row in limits:
            of_class = F.when(c["length_class"] == row["length_class"], row["limit"]).otherwise(of_class)
        return c["step"] < of_class

    added = F.transform(
        F.filter("candidates", kept),
        lambda c: F.struct(
            c["start"].alias("start"), F.lit(len(PATTERNS)).alias("rank"), c["end"].alias("end"), F.lit("random").alias("kind")
        ),
    )
    return found.select("doc_id", "base", F.array_sort(F.concat("base", added)).alias("all_spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts, hash and list of the spans of each document."""
    counts = [count_of("base", kind).alias(f"n_{kind}") for kind in PATTERNS]
    base = written(F.col("base"))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), written(F.col("all_spans")).alias("spans"))
