"""The language model against plain dictionaries."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from playthrough.llm import language_model as lm
from playthrough.llm import packed

BEGIN, END = object(), object()


def tokens_of(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for space in "\t\n\x0b\x0c\r":
        lower = lower.replace(space, " ")
    return [w for w in lower.split(" ") if w] + [END]


def counts_of(docs):
    counts = Counter()
    for _, text in docs:
        t = [BEGIN, BEGIN, *tokens_of(text)]
        for i in range(2, len(t)):
            counts.update([(t[i],), (t[i - 1], t[i]), (t[i - 2], t[i - 1], t[i])])
    counts[(BEGIN,)] = counts[(BEGIN, BEGIN)] = len(docs)
    return counts


def brute(docs):
    def crc(x):
        return zlib.crc32(x.encode())

    def name(i):
        return "" if i is None else str(i)

    train = [d for d in docs if crc(name(d[0])) % 7 != 2]
    kept = [d for d in train if crc(name(d[0]) + ":held out") % 16 != 0]
    tuning = [d for d in train if crc(name(d[0]) + ":held out") % 16 == 0]
    full, less = counts_of(train), counts_of(kept)
    n, n_less = (sum(len(tokens_of(t)) for _, t in part) for part in (train, kept))
    v = len({w for _, t in train for w in tokens_of(t)})

    def estimates(counts, total, t, i):
        two, one = counts[(t[i - 2], t[i - 1])], counts[(t[i - 1],)]
        c = 65 + two.bit_length() if two else one.bit_length()
        found = (
            counts[tuple(t[i - 2 : i + 1])] / two if two else 0.0,
            counts[tuple(t[i - 1 : i + 1])] / one if one else 0.0,
            counts[(t[i],)] / total if total else 0.0,
            1 / (v + 1),
        )
        return c, found

    events = []
    for _, text in tuning:
        t = [BEGIN, BEGIN, *tokens_of(text)]
        events += [estimates(less, n_less, t, i) for i in range(2, len(t))]

    def exists(c):
        return [c > 65, c > 0, n_less > 0, True]

    weights = defaultdict(list, {c: [e / sum(exists(c)) for e in exists(c)] for c in range(130)})
    for _ in range(lm.ROUNDS):
        uses = {c: [float(e) for e in exists(c)] for c in range(130)}
        for c, found in events:
            mixed = [a * b for a, b in zip(found, weights[c])]
            for k in range(4):
                uses[c][k] += mixed[k] / sum(mixed)
        before, weights = weights, {c: [u / sum(us) for u in us] for c, us in uses.items()}
        if max(abs(a - b) for c in range(130) for a, b in zip(weights[c], before[c])) < lm.SETTLED:
            break
    out = []
    for i, text in docs:
        t = [BEGIN, BEGIN, *tokens_of(text)]
        score = base = 0.0
        known = 0
        for k in range(2, len(t)):
            c, found = estimates(full, n, t, k)
            score += math.log10(sum(a * b for a, b in zip(found, weights[c])))
            base += math.log10((full[(t[k],)] + 1) / (n + v + 1))
            known += full[(t[k],)] > 0
        out.append((-1 if i is None else i, crc(name(i)) % 7 == 2, len(t) - 2, known, n, round(base, 6), round(score, 5)))
    return sorted(out)


def scored(df):
    rows = lm.score(df).collect()
    return sorted(
        (-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 5))
        for r in rows
    )


def sentences(seed, n, vocabulary=40):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(vocabulary)] + ["Wort", "É", "日本"]

    def one():
        return " ".join(words[min(int(rng.expovariate(0.2)), len(words) - 1)] for _ in range(rng.randrange(0, 30)))

    return [(k, one()) for k in range(n)]


EDGES = [(1000, None), (1001, ""), (1002, " \t\n"), (None, "w1 w2"), (1003, "A b\x0bC a b"), (3, "w1 w1 w1"), (3, "new words only")]


@pytest.mark.parametrize("chunk", [7, 200, lm.CHUNK])
def test_equals_plain_counts(spark, docs_of, monkeypatch, chunk):
    """Small chunks cut documents into pieces, with contexts in other chunks."""
    monkeypatch.setattr(lm, "CHUNK", chunk)
    monkeypatch.setattr(lm, "PER_BUCKET", 100 if chunk == 200 else 8_000_000)
    rows = sentences(1, 60) + EDGES
    got, want = scored(docs_of(rows).repartition(3)), brute(rows)
    assert [r[:-1] for r in got] == [r[:-1] for r in want]
    assert [r[-1] for r in got] == pytest.approx([r[-1] for r in want], abs=1e-4)


def test_pieces_of_a_long_text():
    text = "a b c d e f g " * 4
    whole = np.concatenate([p[2:] for p in lm._tokens(text)])
    assert len(whole) == 29 and whole[-1] == lm.END


def test_counts_survive_packing():
    counts = np.array([0, 1, 254, 255, 256, 2**40])
    assert packed.counts_of(packed.packed_counts(counts), 6).tolist() == counts.tolist()
    for values in ([], [0], [2**63, 2**64 - 1], [0, 1, 2, 2**40], list(range(0, 70000, 7))):
        values = np.array(values, dtype=np.uint64)
        assert packed.from_ascending(packed.ascending(values)).tolist() == values.tolist()
        for plain in (0, 2):
            assert packed.from_planes(packed.planes(values, plain)).tolist() == values.tolist()


def test_weights_of_a_class_add_up(spark):
    weights = lm.first_weights(lm.Totals(10, 5, 2))
    assert np.allclose(weights.sum(axis=1), 1) and weights[0].tolist() == [0, 0, 0.5, 0.5]


def test_nothing_to_learn_from(docs_of):
    left_out = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2)
    (row,) = lm.score(docs_of([(left_out, "a b")])).collect()
    assert (row.n_known, row.train_tokens, row.held_out) == (0, 0, True) and row.score == pytest.approx(0.0)


def test_empty_table(docs_of):
    assert lm.score(docs_of([(1, "a")]).limit(0)).collect() == []


def test_better_than_the_base(spark, documents):
    """Held-out documents are likelier under the mixture than under single words."""
    rows = [r for r in lm.score(documents).collect() if r.held_out]
    assert rows and sum(r.score for r in rows) > sum(r.base_score for r in rows)
