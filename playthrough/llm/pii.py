"""Personal data in texts: fixed patterns, and identifiers that stand in the same contexts.

What the fixed patterns find are the seeds. The word before and the word after a span are its lexical patterns.
Seeds and all other tokens (instances), linked to the patterns they stand in, form a graph. In
each round a pattern's score is the mean score of its instances, an instance's score that of the
best pattern it stands in; seeds stay at 1, all else starts at 0. Ordinary words, of letters only, stay at 0 and
only count. Tokens in a pattern of high score that enough different instances support are new finds of kind
``likely`` if they share a mark with seeds of the pattern's kind: digits, or a character that is no letter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playthrough.llm.common import store, text_or_empty
from playthrough.llm.spans import apart, count_of, labelled, with_spans, written

#: Fixed patterns. Possessive where nothing could be given back; an address can begin where the one before ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_LETTER, _ANY = r"[\p{L}\p{M}]", r"[\p{L}\p{M}\p{N}]"
_MARK = r"[^\s,;\"<>{}|\p{L}\p{M}\p{N}]"
_NUMBER = rf"[(\[+]?\p{{N}}++(?:{_MARK}++\p{{N}}++)*+[)\]]?+(?!{_MARK}*+{_LETTER})"
#: Numbers in a row, and other tokens that hold a digit or, inside, a mark.
CANDIDATE = (
    rf"(?<!{_ANY})(?:{_NUMBER}(?:\x20{_NUMBER})*+"
    rf"|[(\[+]?(?:{_LETTER}*+\p{{N}}{_ANY}*+(?:{_MARK}++{_ANY}++)*+|{_ANY}++(?:{_MARK}++{_ANY}++)++)[)\]]?+)"
)
#: Parts of a token that stand beside a seed within it.
PIECE = r"(?<![A-Za-z0-9@._+-])(?=(?:[A-Za-z@._+-]*+[0-9]){4})[A-Za-z0-9@._+-]{6,}+"
ROUNDS = 3
LEAST_SCORE = 0.8
#: Different instances with a score that a pattern needs.
LEAST_SUPPORT = 3
#: Context words with more characters are kept as a digest.
LONGEST_WORD = 40
#: Patterns that are sent to every task, at most; with more, the words are shuffled.
FEW_PATTERNS = 100_000
#: Bits of the lower bound on a pattern's ordinary words, in masks of 64.
MASKS = 4


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _is_address(hit: Column) -> Column:
    """Four parts of 255 or less, leading zeros allowed."""
    return hit.rlike(r"^(?:(?:\A|\.)0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){4}$")


def passes_luhn(digits: Column) -> Column:
    def value(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, twice).otherwise(d)

    values = F.transform(F.split(F.reverse(digits), ""), value)
    return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0


def _is_card(hit: Column) -> Column:
    digits = _digits(hit)
    return F.when(F.char_length(digits).between(12, 19), passes_luhn(digits)).otherwise(False)


def _is_phone(hit: Column) -> Column:
    return F.char_length(_digits(hit)).between(9, 15)


CHECKS = {"ip": _is_address, "card": _is_card, "phone": _is_phone}


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, the spans of each kind and the candidates, with the words around them."""
    read = docs.select("doc_id", text_or_empty().alias("text"))
    found = with_spans(read, "text", PATTERNS | {"candidate": CANDIDATE, "piece": PIECE}, context=True)
    for kind, check in CHECKS.items():
        found = found.withColumn(kind, F.filter(kind, lambda s: check(s["hit"])))
    fixed = F.concat(*PATTERNS)
    found = apart(found.withColumn("fixed", fixed), "candidate", F.col("fixed"))
    found = apart(found, "piece", F.concat("fixed", "candidate"))
    found = found.withColumn("candidate", F.concat("candidate", "piece"))
    return found.select("doc_id", *PATTERNS, "candidate")


def _word(word: Column) -> Column:
    return F.when(F.char_length(word) > LONGEST_WORD, F.md5(word)).otherwise(word)


def _contexts(spans: Column) -> Column:
    """A row for each span and lexical pattern it stands in."""

    def sides(s: Column) -> Column:
        def side(name: str, word: Column) -> Column:
            usable = F.when(F.char_length(word) > 0, F.concat(F.lit(f"{name}:"), _word(word)))
            return F.struct(
                s["start"].alias("start"), s["end"].alias("end"), F.lower(s["hit"]).alias("instance"), usable.alias("pattern")
            )

        return F.array(side("before", s["before"]), side("after", s["after"]))

    return F.filter(F.flatten(F.transform(spans, sides)), lambda c: c["pattern"].isNotNull())


def _graph(found: DataFrame) -> DataFrame:
    """kind, pattern, instance: seeds of the kind have seed 1, all other instances 0. Repeats count once."""

    def edges(spans: str, kinds: list[str], seed: int) -> DataFrame:
        rows = found.select(F.explode(_contexts(F.col(spans))).alias("c")).select("c.pattern", "c.instance")
        once = rows.groupBy("pattern", "instance").agg(F.lit(seed).alias("seed"))
        return once.withColumn("kind", F.explode(F.array(*map(F.lit, kinds))))

    graph = edges("candidate", list(PATTERNS), 0)
    for kind in PATTERNS:
        graph = graph.unionByName(edges(kind, [kind], 1))
        graph = graph.unionByName(edges(kind, [k for k in PATTERNS if k != kind], 0))
    return graph.groupBy("kind", "pattern", "instance").agg(F.max("seed").alias("seed"))


def _ordinary(docs: DataFrame) -> DataFrame:
    """pattern, word: a row for each ordinary word and each of the two patterns it stands in."""
    words = F.filter(F.split(F.lower(text_or_empty()), r"\s+"), lambda w: w != "")
    kept = F.transform(words, lambda w: F.struct(_word(w).alias("w"), F.when(~w.rlike(CANDIDATE), w).alias("ordinary")))
    pairs = docs.select(kept.alias("w")).filter(F.size("w") > 1)
    pairs = pairs.select(F.explode(F.arrays_zip(F.expr("slice(w, 1, size(w) - 1)").alias("a"), F.expr("slice(w, 2, size(w) - 1)").alias("b"))).alias("p"))

    def side(name: str, context: str, word: str) -> Column:
        return F.struct(F.concat(F.lit(f"{name}:"), F.col(f"p.{context}.w")).alias("pattern"), F.col(f"p.{word}.ordinary").alias("word"))

    both = pairs.select(F.explode(F.array(side("before", "a", "b"), side("after", "b", "a"))).alias("c"))
    return both.filter("c.word IS NOT NULL").select("c.pattern", F.btrim("c.word", F.lit(".,;:!?()[]\"'")).alias("word"))


def ordinary_words(docs: DataFrame, graph: DataFrame) -> DataFrame:
    """pattern, others: the different ordinary words in each pattern of the graph that has enough instances.

    Masks with a bit per hash give a lower bound from one row per task and pattern. Where it leaves a score of
    LEAST_SCORE possible, words are counted; where not, the bound stands for the count.
    """
    instances = graph.groupBy("pattern").agg(F.countDistinct("instance").alias("n")).filter(F.col("n") >= LEAST_SUPPORT)
    edges = _ordinary(docs)
    code = F.xxhash64("word")
    bit = F.expr("shiftleft(1L, cast(pmod(code, 64) AS int))")
    masks = [F.bit_or(F.when(F.pmod(F.shiftright("code", 6), F.lit(MASKS)) == k, bit).otherwise(F.lit(0).cast("long"))).alias(f"m{k}") for k in range(MASKS)]
    bits = sum((F.bit_count(f"m{k}") for k in range(1, MASKS)), F.bit_count("m0"))
    bound = edges.withColumn("code", code).groupBy("pattern").agg(*masks).select("pattern", bits.cast("long").alias("least"))
    bound = store(bound.join(instances, "pattern"), "bounds")
    possible = F.col("n") >= LEAST_SCORE * (F.col("n") + F.col("least"))
    open_ = bound.filter(possible).select("pattern")
    if open_.count() <= FEW_PATTERNS:
        open_ = F.broadcast(open_)
    words = edges.join(open_, "pattern").groupBy("pattern").agg(F.countDistinct("word").alias("others"))
    return store(words.unionByName(bound.filter(~possible).select("pattern", F.col("least").alias("others"))), "others")


def _marks(token: Column) -> Column:
    """The characters that are no letters; all digits count as one."""
    marks = F.regexp_replace(F.regexp_replace(token, r"[\p{L}\p{M}\s]++", ""), r"\p{N}++", "0")
    return F.array_distinct(F.filter(F.split(marks, ""), lambda m: m != ""))


def seed_marks(found: DataFrame) -> DataFrame:
    """kind, marks: what the seeds of each kind hold besides letters."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.array_distinct(F.flatten(F.transform(k, lambda s: _marks(s["hit"])))).alias("marks")) for k in PATTERNS])
    each = found.select(F.explode(kinds).alias("k")).select("k.kind", F.explode("k.marks").alias("mark"))
    return each.groupBy("kind").agg(F.collect_set("mark").alias("marks"))


def pattern_scores(graph: DataFrame, others: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """kind, pattern, score, support after some rounds over the graph (kind, pattern, instance, seed).

    others: pattern, others, the number of further instances, whose score is 0.
    """
    edges = store(graph.withColumn("score", F.col("seed").cast("double")), "graph")
    scored = F.when(F.col("score") >= LEAST_SCORE, 1)
    for last in [False] * (rounds - 1) + [True]:
        sums = [F.sum("score").alias("sum"), F.count(F.lit(1)).alias("n"), F.count(scored).alias("support")]
        patterns = edges.groupBy("kind", "pattern").agg(*sums).filter(F.col("support") >= LEAST_SUPPORT).join(others, "pattern", "left")
        mean = F.col("sum") / (F.col("n") + F.coalesce("others", F.lit(0)))
        patterns = patterns.select("kind", "pattern", mean.alias("mean"), "support")
        good = store(patterns.filter((F.col("mean") >= LEAST_SCORE) & (F.col("support") >= LEAST_SUPPORT)), "patterns")
        if last or good.isEmpty():
            return good.select("kind", "pattern", F.col("mean").alias("score"), "support")
        best = edges.join(good, ["kind", "pattern"]).groupBy("kind", "instance").agg(F.max("mean").alias("best"))
        raised = edges.join(store(best, "instances"), ["kind", "instance"], "left")
        score = F.when(F.col("seed") == 1, 1.0).otherwise(F.coalesce("best", F.lit(0.0)))
        edges = store(raised.select("kind", "pattern", "instance", "seed", score.alias("score")), "graph")


def find_personal_data(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, base and all_spans (arrays of start, rank, end, kind; code points).

    A null or empty text has none. Rows with null or repeated ids are rows of their own. Columns other than
    doc_id and text are ignored; an empty table gives an empty result.
    """
    found = store(scan(docs).withColumn("row", F.monotonically_increasing_id()), "personal")
    graph = store(_graph(found), "edges")
    accepted = pattern_scores(graph, ordinary_words(docs, graph), rounds).select("kind", "pattern")
    accepted = accepted.join(store(seed_marks(found), "marks"), "kind")
    standing = found.select("row", F.explode(_contexts(F.col("candidate"))).alias("c")).select("row", "c.*")
    alike = F.arrays_overlap(_marks(F.col("instance")), F.col("marks"))
    finds = standing.join(accepted, "pattern").filter(alike).select("row", "start", "end").distinct()
    rank, kind = F.lit(len(PATTERNS)).alias("rank"), F.lit("likely").alias("kind")
    per_row = finds.groupBy("row").agg(F.collect_list(F.struct("start", rank, "end", kind)).alias("likely"))
    base = found.select("row", "doc_id", labelled(list(PATTERNS)).alias("base"))
    joined = base.join(per_row, "row", "left")
    every = F.when(F.col("likely").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "likely")))
    return joined.select("doc_id", "base", every.alias("all_spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts, hash and list of the spans of each document."""
    counts = [count_of("base", kind).alias(f"n_{kind}") for kind in PATTERNS]
    base = written(F.col("base"))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), written(F.col("all_spans")).alias("spans"))
