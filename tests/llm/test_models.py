"""Classifier, packing, joins: against brute force, round trips and held-out labels."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from playthrough.llm import cap_filters, graph, ngram_join, packing, quality
from playthrough.llm.queries import word_tokenizer
from playthrough.llm.tokens import WordIds


class Sets:
    def __init__(self, items):
        self.of = {i: i for i in items}

    def root(self, i):
        while self.of[i] != i:
            i = self.of[i]
        return i

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.of[max(a, b)] = min(a, b)


# --- tokens and packing


def test_ids_equal_those_of_the_tokenizer(documents):
    words = WordIds(word_tokenizer())
    texts = [r.text for r in documents.select("text").collect()]
    texts += ["<|endoftext|>x it's 12a", "ΑΣ ΣΑΣ", "é e\u0301 İ", "a\x1cb c\x85d\u3000e", "日本 語😀", "", "ÿ", "don'T'S"]
    for text in texts:
        want = words.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(words.of_text(text), "<u4").tolist() == want, text[:80]


def _check_packing(rows, texts):
    words = WordIds(word_tokenizer())
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for r_id, text in texts.items():
        ids = np.append(np.frombuffer(words.of_text(text or ""), "<u4"), 1).astype("<u4")
        at = 0
        for r in sorted(by_doc[r_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for rs in by_sequence.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.CAPACITY
    return sum(r.length for r in rows) / (packing.CAPACITY * len(by_sequence))


def test_every_token_has_one_place(documents):
    rows = packing.pack(documents, word_tokenizer()).collect()
    filled = _check_packing(rows, {r.doc_id: r.text for r in documents.collect()})
    assert filled > 0.97


def test_packing_of_odd_rows(docs_of):
    rows = packing.pack(docs_of([(1, None), (2, ""), (3, "a " * 2047), (4, "a " * 2048), (5, "b " * 50_000)]), word_tokenizer()).collect()
    _check_packing(rows, {1: None, 2: "", 3: "a " * 2047, 4: "a " * 2048, 5: "b " * 50_000})
    twice = packing.pack(docs_of([(1, "x y"), (1, "x y"), (None, "z")]), word_tokenizer()).collect()
    assert len({(r.sequence_id, r.offset) for r in twice}) == 3
    assert packing.pack(docs_of([]), word_tokenizer()).count() == 0


def test_patterns_cover_every_length():
    rng = np.random.default_rng(3)
    for n in (1, 7, 300, 20_000):
        sizes, counts = np.unique(rng.integers(1, 65, n), return_counts=True)
        patterns = packing.plan(dict(zip(sizes.tolist(), counts.tolist())), 64)
        covered = defaultdict(int)
        for pattern, amount in patterns:
            assert sum(s * c for s, c in pattern.items()) <= 64
            for s, c in pattern.items():
                covered[s] += c * amount
        assert covered == dict(zip(sizes.tolist(), counts.tolist()))
    assert sum(a for _, a in patterns) <= 1.01 * (sizes * counts).sum() / 64 + 2


# --- quality


def test_held_out_labels_are_predicted(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    scored = quality.score(docs, labels)
    rows = scored.join(labels, "doc_id").collect()
    tested = [r for r in rows if r.held_out]
    assert scored.count() == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.predicted == r.quality for r in tested) / len(tested) > 0.9
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality.score(docs, flipped).collect()}
    assert all(again[r.doc_id] == r.score for r in rows)


def test_quality_of_odd_rows(docs_of, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    docs = docs_of([(1, None), (2, ""), (3, "word"), (None, "x"), (3, "word"), (4, "y " * 600_000)])
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    one = spark.createDataFrame([(3, 1), (3, 0), (9, 1), (1, None)], "doc_id long, quality int")
    rows = quality.score(docs, one).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    assert quality.accepted(docs, none).count() == 6
    assert quality.score(docs_of([]), one).count() == 0


# --- graph and joins


def test_components_of_random_graphs(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(5, 5)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    sets = Sets({n for e in edges for n in e})
    for a, b in edges:
        sets.join(a, b)
    assert all(got[n] == sets.root(n) for e in edges if e[0] != e[1] for n in e)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def _shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _brute_components(texts):
    found, sets = {i: _shingle_set(t) for i, t in texts.items()}, Sets(texts)
    ids = list(texts)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(found[a] & found[b])
            if common and 100 * common >= 75 * (len(found[a]) + len(found[b]) - common):
                sets.join(a, b)
    return found, sets


def test_ngram_join_equals_brute_force(docs_of, monkeypatch):
    rng = random.Random(4)
    texts = {0: None, 1: "", 2: " \t", 3: "one", 4: "ONE", 5: "one two three four", 6: "One two  three\nfour", 7: "É a b c d e", 8: "é a b c d e"}
    passage = [f"p{i}" for i in range(60)]
    base = [f"b{rng.randrange(40)}" for _ in range(120)]
    for i in range(10, 90):
        words = list(base) if i < 60 else [f"w{rng.randrange(3000)}" for _ in range(40)] + passage
        for _ in range(rng.randrange(6)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(50)}"
        texts[i] = " ".join(words[: len(words) - rng.randrange(4)])
    for i in range(90, 96):
        texts[i] = texts[rng.randrange(10, 90)]
    got = {r.doc_id: r for r in ngram_join.near_duplicates(docs_of(list(texts.items()))).collect()}
    found, sets = _brute_components(texts)
    assert all(got[i].n_shingles == len(found[i]) for i in texts)
    assert {i: got[i].component_id for i in texts} == {i: sets.root(i) for i in texts}


def test_any_order_of_ngrams_gives_the_same_links():
    rng = np.random.default_rng(6)
    x = np.unique(rng.integers(0, 2**63, 200).astype(np.uint64))
    codes = np.sort(ngram_join._code(x[rng.random(len(x)) < 0.5], 64))
    ranks = rng.permutation(len(codes))
    y = np.unique(np.r_[x[10:], rng.integers(0, 2**63, 15).astype(np.uint64)])
    first = [set(ngram_join.in_order(s, 64, codes, ranks, ngram_join.prefix_length(len(s))).tolist()) for s in (x, y)]
    assert first[0] & first[1]
    assert len(ngram_join.in_order(x, 64, codes, ranks, len(x))) == len(x)


@pytest.mark.parametrize("frequent", [0, 0.3])
def test_trie_equals_set_intersections(frequent):
    rng = np.random.default_rng(8)
    base = np.unique(rng.integers(0, 2**62, 300).astype(np.uint64))
    sets = [base]
    for _ in range(60):
        kept = base[rng.random(len(base)) < rng.choice([0.2, 0.6, 0.8, 0.95, 1.0])]
        sets.append(np.unique(np.r_[kept, rng.integers(0, 2**62, rng.integers(0, 60)).astype(np.uint64)]))
    codes = np.sort(ngram_join._code(base[rng.random(len(base)) < frequent], 64))
    ranks = rng.permutation(len(codes))
    found = ngram_join.trie_matches(base, sets, lambda g: ngram_join.global_places(g, 64, codes, ranks))
    want = [k for k, s in enumerate(sets) if (c := len(np.intersect1d(base, s))) * 4 >= 3 * (len(base) + len(s) - c)]
    assert sorted(found) == want


def test_similar_sets_can_meet_at_their_first_common_ngram():
    """For sets of any size and overlap, the positions of the first n-gram in common allow the pair if it is similar."""
    rng = np.random.default_rng(3)
    similar = 0
    for _ in range(4000):
        n = int(rng.integers(1, 40))
        universe = rng.permutation(80)
        x = np.sort(universe[:n])
        y = np.sort(np.r_[x[rng.random(n) < 0.93], universe[n : n + rng.integers(0, 6)]])
        common = np.intersect1d(x, y)
        if not len(y) or 4 * len(common) < 3 * (len(x) + len(y) - len(common)):
            continue
        similar += 1
        sizes, places = np.array([len(x), len(y)]), np.array([np.flatnonzero(s == common[0])[0] for s in (x, y)])
        order = np.argsort(sizes, kind="stable")
        most = ngram_join.largest_partner(sizes, places)
        assert ngram_join.possible_members(sizes[order], most[order]).all() and most[order[0]] >= sizes[order[0]]
        assert all(p < ngram_join.prefix_length(s) for p, s in zip(places, sizes))
    assert similar > 1000


def test_long_lists_keep_every_pair(docs_of, monkeypatch):
    """Blocks of a few members, on texts that share much: the same components as by brute force."""
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    monkeypatch.setattr(ngram_join, "TRIES", 1)
    rng = random.Random(12)
    base = [f"b{i}" for i in range(80)]
    texts = {}
    for i in range(60):
        words = list(base)
        for _ in range(rng.randrange(3, 9)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(9)}"
        texts[i] = " ".join(words[: len(words) - rng.randrange(6)])
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs_of(list(texts.items()))).collect()}
    _, sets = _brute_components(texts)
    assert got == {i: sets.root(i) for i in texts} and len(set(got.values())) > 3


def test_ngram_join_of_nothing(docs_of):
    assert ngram_join.near_duplicates(docs_of([])).count() == 0
    rows = ngram_join.near_duplicates(docs_of([(None, "a b"), (1, None), (2, "a b"), (2, "a b")])).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in rows) == [(0, 0), (1, 1), (2, 2), (2, 2)]


@pytest.mark.parametrize("block", [cap_filters.BLOCK, 40])
def test_embedding_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(cap_filters, "BLOCK", block)
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((150, 32))
    x = [c + 0.15 * rng.standard_normal(32) for c in centres for _ in range(2)] + [centres[0] + 0.1 * rng.standard_normal(32) for _ in range(150)]
    x += [x[0], x[0] * 2, x[5]]
    rows = [(i, [float(v) for v in np.float32(e)]) for i, e in enumerate(x)]
    bad = [None, [], [0.0] * 32, [float("nan")] * 32, [float("inf")] + [1.0] * 31, [None] + [1.0] * 31, [1.0, 2.0]]
    rows += [(1000 + i, b) for i, b in enumerate(bad)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("label", F.lit(1)).withColumn("block", F.lit(2))
    got = {r.vec_id: r for r in cap_filters.near_duplicates(df).collect()}
    assert len(got) == len(rows)
    v = np.array([np.float32(e) for e in x], dtype=np.float64)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    close = v @ v.T >= 0.95
    np.fill_diagonal(close, False)
    assert all(got[i].n_links <= close[i].sum() for i in range(len(x)))
    assert sum(got[i].n_links for i in range(len(x))) >= 0.97 * close.sum()
    assert all(got[1000 + i].n_links == 0 and got[1000 + i].kept for i in range(len(bad)))
    assert all(r.kept == (r.component_id == r.vec_id) for r in got.values())


@pytest.mark.parametrize("n", [2_000, 1_000_000, 10_000_000])
@pytest.mark.parametrize("dimensions", [16, 64])
def test_directions_meet_whatever_the_number_of_vectors(n, dimensions):
    per_half, share = cap_filters.codes_for(n)
    books = cap_filters._codebooks(dimensions, per_half)
    rng, met = np.random.default_rng(4), 0
    for _ in range(200):
        x, y = rng.standard_normal((2, dimensions))
        x /= np.linalg.norm(x)
        y -= x * (x @ y)
        y = 0.95 * x + (1 - 0.95**2) ** 0.5 * y / np.linalg.norm(y)
        a, b = (cap_filters.passed_directions(v, books, share) for v in (x, y))
        assert min(len(a), len(b)) >= cap_filters.PASSED and len(np.unique(a)) == len(a)
        met += len(np.intersect1d(a, b)) > 0
    assert met >= 0.97 * 200


def test_tied_directions_do_not_add_up():
    per_half, share = cap_filters.codes_for(1_000_000)
    assert len(cap_filters.passed_directions(np.ones(1), cap_filters._codebooks(1, per_half), share)) == cap_filters.PASSED


def test_vectors_that_share_an_id_have_links_of_their_own(spark):
    near = [0.99, 0.1, 0.0, 0.0]
    rows = [(1, [1.0, 0.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0, 0.0]), (2, near), (3, [0.1, 0.99, 0.0, 0.0]), (3, near), (0, [0.0, 0.0, 1.0, 0.0])]
    rows += [(7, [0.0, 0.0, 0.0, 1.0]), (7, [0.0, 0.0, 0.1, 0.99])]
    got = cap_filters.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    x = np.array([np.float32(e) for _, e in rows], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    close = x @ x.T >= 0.95
    sets = Sets(range(len(rows)))
    for a, b in zip(*np.nonzero(close)):
        sets.join(int(a), int(b))
    smallest = {}
    for k, (i, _) in enumerate(rows):
        smallest[sets.root(k)] = min(i, smallest.get(sets.root(k), i))
    want = sorted((i, int(close[k].sum()) - 1, smallest[sets.root(k)]) for k, (i, _) in enumerate(rows))
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == want


def test_embeddings_of_nothing(spark):
    assert cap_filters.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
