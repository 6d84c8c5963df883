"""The pipeline against brute force over planted copies, near copies and repeated ids."""

import random
from collections import Counter

import corpus_pipeline
from playthrough.llm import mixing, packing
from playthrough.llm.queries import word_tokenizer


def _shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def _groups(rows):
    """Lists of rows (id, text) that links connect."""
    groups, shingles = [], [_shingles(t) for _, t in rows]
    for k in range(len(rows)):
        near = [g for g in groups if any(4 * len(shingles[k] & shingles[i]) >= 3 * len(shingles[k] | shingles[i]) for i in g)]
        groups = [g for g in groups if g not in near] + [[k, *sum(near, [])]]
    return [[rows[k] for k in g] for g in groups]


def _rows():
    rng = random.Random(3)

    def text(n=60):
        return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))

    def near(t):
        words = t.split()
        words[rng.randrange(5, 55)] = f"x{rng.randrange(10**6)}"
        return " ".join(words)

    rows = [(i, text()) for i in range(100, 140)]
    rows += [(200 + i, t) for i, (_, t) in enumerate(rows[:8])]  # copies
    rows += [(300 + i, near(t)) for i, (_, t) in enumerate(rows[10:18])]
    a, b = text(), text()
    rows += [(10, a), (5, near(a)), (10, text())]  # one text of an id is linked to a smaller id, the other is not
    rows += [(7, b), (7, near(b))]  # similar texts under one id
    return rows


def test_near_duplicates_go_by_row_and_not_by_id(spark, docs_of):
    rows = sorted(set(_rows()))
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs_of(rows + [(None, rows[0][1])]), "").collect()]
    assert (None, rows[0][1]) in got
    got.remove((None, rows[0][1]))
    groups = _groups(rows)
    assert len(got) == len(groups)
    for group in groups:
        stays = [r for r in group if r in got]
        assert len(stays) == 1 and stays[0][0] == min(group)[0]


def test_pipeline_equals_brute_force(spark, docs_of, tmp_path):
    rows = _rows()
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    once = {}
    for i, t in rows:
        once[t] = max(i, once.get(t, i))
    kept = [min(g) for g in _groups([(i, t) for t, i in once.items()])]
    want = packing.pack(mixing.mix(docs_of(kept)), word_tokenizer()).collect()
    assert Counter(r.doc_id for r in got if r.start == 0) == Counter(r.doc_id for r in want if r.start == 0)
    # Of id 7 either text may stay.
    assert Counter((r.doc_id, r.start, r.doc_tokens) for r in got if r.doc_id != 7) == Counter((r.doc_id, r.start, r.doc_tokens) for r in want if r.doc_id != 7)
