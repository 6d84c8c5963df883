"""Training and scoring."""

import random

import numpy as np
import pytest
from frames import enriched, random_events
from pyspark.sql import functions as F

from playthrough.operators import features
from playthrough.plans import model

SCHEMA = "event_id string, event_ts bigint, kind string, a double, b int, empty double, is_completion int"


def rows(n=600, seed=0):
    rng = random.Random(seed)
    for i in range(n):
        kind = rng.choice(["x", "y", None])
        a, b = rng.gauss(0, 1), rng.randrange(100)
        z = 1.2 * a - 0.02 * b + (kind == "x") + rng.gauss(0, 1)
        yield f"e{i:04d}", i, kind, None if rng.random() < 0.1 else a, b, None, int(z > 0)


def newton(x, y, weight, penalty):
    """Minimum of the weighted mean loss plus penalty / 2 * |w|², without penalty on the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    reg = np.diag([penalty] * (x.shape[1] - 1) + [0.0])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        gradient = x.T @ (weight * (p - y)) / weight.sum() + reg @ w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x / weight.sum() + reg
        w -= np.linalg.solve(hessian, gradient)
    return w


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(list(rows()), SCHEMA).repartition(4).cache()


@pytest.fixture(scope="module")
def fitted(table):
    return model.fit(model.labelled(table), max_iter=200, tol=1e-9)


def test_coefficients_minimise_the_balanced_penalised_loss(spark, table, fitted):
    data = list(rows())
    known = [r[3] for r in data if r[3] is not None]
    mean = sum(known) / len(known)
    x = np.array([[mean if r[3] is None else r[3], r[4], r[2] == "x", r[2] == "y"] for r in data], dtype=float)
    y = np.array([r[6] for r in data], dtype=float)
    weight = np.where(y == 1, len(y) / 2 / y.sum(), len(y) / 2 / (len(y) - y.sum()))
    want = newton(x, y, weight, 1 / len(y))
    found = model.coefficients(spark, fitted).orderBy("position").collect()
    assert [r["feature"] for r in found] == ["a", "b", "kind_x", "kind_y"]
    assert [r["coefficient"] for r in found] == pytest.approx(want[:4], abs=1e-4)
    assert fitted.stages[-1].intercept == pytest.approx(want[4], abs=1e-4)


def test_saved_model_scores_the_same(spark, table, fitted, tmp_path):
    path = str(tmp_path / "model")
    model.save(fitted, path)
    model.save(fitted, path)
    a, b = (sorted(map(tuple, model.score(m, table).collect())) for m in (fitted, model.load(path)))
    assert a == b


def test_predictions_follow_the_probability(table, fitted):
    for r in model.apply(fitted, table).collect():
        assert r["prediction"] == int(r[model.PROBABILITY] > 0.5)


def test_means_come_from_the_given_rows(table):
    train = model.labelled(table.filter("event_ts < 300"))
    own = model.fit(train).stages[0].surrogateDF.first()
    everyone = model.fit(train, impute_from=table).stages[0].surrogateDF.first()
    known = [r[3] for r in rows() if r[3] is not None]
    assert everyone["a"] == pytest.approx(sum(known) / len(known))
    assert own["a"] != everyone["a"]


def test_unknown_and_null_categories_score_alike(spark, fitted):
    df = spark.createDataFrame([("p", 0, "new", 1.0, 5, None, 0), ("q", 0, None, 1.0, 5, None, 0)], SCHEMA)
    found = model.score(fitted, df).collect()
    assert found[0][1] == found[1][1]


def test_align_fills_missing_columns_with_zero(spark, fitted):
    df = spark.createDataFrame([("p", "x", None)], "event_id string, kind string, b int")
    aligned = model.align(df, fitted)
    assert aligned.columns == ["event_id", "a", "b", "kind"]
    assert tuple(aligned.first()) == ("p", 0.0, 0.0, "x")
    zeros = spark.createDataFrame([("p", 0, "x", 0.0, 0, None, 0)], SCHEMA)
    assert model.score(fitted, aligned).first() == model.score(fitted, zeros).first()


def test_hashed_categories_need_no_list(spark, table, tmp_path, monkeypatch):
    """With a place for each category, the same predictions; with as many categories as rows, no list of them anywhere."""
    from pyspark.ml.feature import StringIndexerModel

    train = model.labelled(table)
    by_list, by_hash = model.fit(train), model.fit(train, hashed=64)
    assert not any(isinstance(s, StringIndexerModel) for s in by_hash.stages)
    a, b = (dict(model.score(m, table).collect()) for m in (by_list, by_hash))
    assert all(a[k] == pytest.approx(b[k], abs=1e-6) for k in a)
    path = str(tmp_path / "model")
    model.save(by_hash, path)
    assert dict(model.score(model.load(path), table).collect()) == b
    names = [r["feature"] for r in model.coefficients(spark, by_hash).collect()]
    assert names[:3] == ["a", "b", "hashed_0"] and len(names) == 2 + 64 and model.model_inputs(by_hash)[1] == ["kind"]

    many = train.withColumn("kind", F.col("event_id"))
    wide = model.fit(many, hashed=2**18, max_iter=3)
    assert wide.stages[-1].numFeatures == 2 + 2**18 and model.score(wide, many).count() == 600


def test_whole_run_on_features(spark):
    import datetime

    df = enriched(spark, random_events(8, 400))
    table = features.completion_prediction_features(df, ["g0", "g1", "g2"], datetime.date(2025, 1, 1)).cache()
    fitted, evaluation = model.train_and_evaluate(table)
    report = {r["class"]: r["support"] for r in evaluation.report.collect()}
    assert report["accuracy"] == 80
    assert 0.0 <= evaluation.roc_auc.first()[0] <= 1.0
    assert 0.0 <= evaluation.average_precision.first()[0] <= 1.0
    numeric, categorical = model.model_inputs(fitted)
    assert "user_activity_level" in numeric and "device" in categorical
    assert not set(model.NOT_FEATURES) & set(numeric + categorical)
    aligned = model.align(df, fitted)
    assert model.score(fitted, aligned).count() == 400


def test_plain_features_score_as_the_vectors_do(table, fitted):
    """The expressions that replace MLlib's vectors hold their values, for gaps, unknown and null categories too."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array

    odd = table.withColumn("kind", F.when(F.col("event_ts") % 5 == 0, "new").otherwise(F.col("kind")))
    odd = odd.withColumn("a", F.when(F.col("event_ts") % 7 == 0, float("nan")).otherwise(F.col("a")))
    vectors = PipelineModel(fitted.stages[:-1]).transform(model.typed(odd, ["a", "b"]))
    plain = model.plain_features(fitted.stages[:-1])
    got = vectors.select(F.array(*plain).alias("plain"), vector_to_array("features").alias("x")).collect()
    assert all(r["plain"] == r["x"] for r in got)
    by_mllib = fitted.transform(model.typed(odd, ["a", "b"])).select("event_id", vector_to_array("probability")[1], "prediction")
    want = {r[0]: (r[1], r[2]) for r in by_mllib.collect()}
    for r in model.apply(fitted, odd).collect():
        probability, prediction = want[r["event_id"]]
        assert r[model.PROBABILITY] == pytest.approx(probability, abs=1e-12) and r["prediction"] == prediction


def test_stored_features_are_spread(spark, monkeypatch):
    """A table made in one task per title is stored after a shuffle by event, in columns."""
    from playthrough import registry

    made = spark.range(0, 4000, 1, 1).selectExpr("cast(id as string) event_id", "id")
    monkeypatch.setattr(registry, "completion_prediction_features", lambda *_: made)
    dealt = []
    monkeypatch.setattr(registry, "spread", lambda df, *by: dealt.append(by) or df.repartition(*by))
    found = registry._stored_features(spark, "")
    assert dealt == [("event_id",)]
    assert found.count() == 4000 and found.select(F.max("id")).first()[0] == 3999
    assert "FileScan" in found._jdf.queryExecution().executedPlan().toString()
