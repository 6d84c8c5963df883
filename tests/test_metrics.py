"""Metrics against plain loops."""

import math
import random

import pytest

from playthrough.functions import metrics


def scored(spark, pairs):
    return spark.createDataFrame([(int(y), float(s)) for y, s in pairs], "label int, score double")


def pairs(seed, n=400, levels=50):
    rng = random.Random(seed)
    return [(rng.random() < 0.4, round(rng.random() * levels) / levels) for _ in range(n)]


def value(df):
    return df.first()[0]


@pytest.mark.parametrize("seed", [1, 2])
def test_auc_is_the_share_of_rightly_ranked_pairs(spark, seed):
    data = pairs(seed)
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    wins = sum((p > q) + (p == q) / 2 for p in pos for q in neg)
    assert value(metrics.roc_auc(scored(spark, data))) == pytest.approx(wins / len(pos) / len(neg), abs=1e-12)


def curve(data):
    p = sum(y for y, _ in data)
    n = len(data) - p
    for s in sorted({s for _, s in data}, reverse=True):
        tp = sum(y for y, x in data if x >= s)
        fp = sum(not y for y, x in data if x >= s)
        yield s, tp, fp, p, n


def test_average_precision(spark):
    data = pairs(3)
    want, last = 0.0, 0.0
    for _, tp, fp, p, _ in curve(data):
        want += (tp / p - last) * tp / (tp + fp)
        last = tp / p
    assert value(metrics.average_precision(scored(spark, data))) == pytest.approx(want, abs=1e-8)


def test_pr_curve(spark):
    data = pairs(4)
    want = {(s, tp / (tp + fp), tp / p) for s, tp, fp, p, _ in curve(data)} | {(None, 1.0, 0.0)}
    assert {tuple(r) for r in metrics.pr_curve(scored(spark, data)).collect()} == want


def test_roc_curve_leaves_out_only_points_on_lines(spark):
    data = [(1, 0.9), (1, 0.8), (1, 0.7), (0, 0.6), (1, 0.5), (0, 0.5), (0, 0.4), (0, 0.3)]
    found = {tuple(r) for r in metrics.roc_curve(scored(spark, data)).collect()}
    assert found == {
        (None, 0.0, 0.0), (0.9, 0.0, 0.25), (0.7, 0.0, 0.75), (0.6, 0.25, 0.75), (0.5, 0.5, 1.0), (0.3, 1.0, 1.0),
    }


def test_report(spark):
    rows = [(0, 0)] * 5 + [(0, 1)] * 3 + [(1, 0)] * 2 + [(1, 1)] * 4
    df = spark.createDataFrame(rows, "label int, prediction int")
    found = {r["class"]: tuple(r)[1:] for r in metrics.classification_report(df).collect()}
    f0, f1 = 10 / 15, 8 / 13
    want = {
        "0": (5 / 7, 5 / 8, f0, 8),
        "1": (4 / 7, 4 / 6, f1, 6),
        "accuracy": (9 / 14,) * 3 + (14,),
        "macro avg": ((5 / 7 + 4 / 7) / 2, (5 / 8 + 4 / 6) / 2, (f0 + f1) / 2, 14),
        "weighted avg": ((40 / 7 + 24 / 7) / 14, (5 + 4) / 14, (8 * f0 + 6 * f1) / 14, 14),
    }
    assert found.keys() == want.keys()
    for name in want:
        assert found[name] == pytest.approx(want[name])


def test_report_is_zero_where_undefined(spark):
    df = spark.createDataFrame([(0, 0)] * 3, "label int, prediction int")
    found = {r["class"]: tuple(r)[1:] for r in metrics.classification_report(df).collect()}
    assert found["1"] == (0.0, 0.0, 0.0, 0)


def test_balanced_weights_add_up_to_the_rows(spark):
    df = scored(spark, pairs(5))
    found = metrics.class_weights(df).collect()
    assert math.isclose(sum(r["n_rows"] * r["weight"] for r in found), 400)
    assert len({round(r["n_rows"] * r["weight"], 9) for r in found}) == 1
