"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from playthrough.llm import spelling


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= 3}
    found = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for w, xs in found.items():
        best = min(xs, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(found[w]), n.get(form[w])) for w in n)


def found(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(df).collect())


def texts(seed):
    rng = random.Random(seed)
    letters = "abcdeéÀ×"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randrange(4, 12))) for _ in range(60)]

    def edited(w):
        k, c = rng.randrange(len(w)), rng.choice(letters)
        return rng.choice([w[:k] + w[k + 1 :], w[:k] + c + w[k:], w[:k] + c + w[k + 1 :], w + c, c + w, w])

    pool = stems * 4 + [edited(w) for w in stems for _ in range(6)] + [edited(edited(w)) for w in stems for _ in range(3)]
    return [(i, " ".join(rng.choice(pool).title() if rng.random() < 0.1 else rng.choice(pool) for _ in range(60))) for i in range(80)]


EDGES = [(100, None), (101, ""), (102, "12 , \U0001f600"), (None, "abcde abcde"), (7, "abcde"), (7, "aaaaa aaaaa aaaaa aaaaaa aaaaaa aaaaaa")]


@pytest.mark.parametrize("crowded", [0, 2, spelling.CROWDED])
def test_equals_all_pairs(docs_of, monkeypatch, crowded):
    """Whether chunks that many words share are cut further or not."""
    monkeypatch.setattr(spelling, "CROWDED", crowded)
    rows = texts(crowded) + EDGES
    want = brute(rows)
    assert sum(w[1] is not None for w in want) > 20 and any(w[1] != w[2] for w in want if w[1])
    assert found(docs_of(rows)) == want


def test_words_that_share_a_half_meet_without_all_pairs(spark, monkeypatch):
    """Hundreds of words with one first half: what meets is bounded by the alphabet, not by the group."""
    letters = "abcdefghijklmnopqrst"
    rows = [(f"common{a}{b}{c}{d}xyz", 3) for a in letters for b in letters for c in letters[:4] for d in "ab"]
    table = spark.createDataFrame(rows, "word string, n long")
    pairs = spelling.near_pairs(table).count()
    assert pairs == sum(len(rows) * (k - 1) // 2 for k in (20, 20, 4, 2))


def test_whole_table(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert found(documents) == brute(rows)


def test_empty_table(docs_of):
    assert found(docs_of([(1, "abcde abcde abcde")]).limit(0)) == []
    assert found(docs_of([(1, "abcd abcd abcd")])) == []
