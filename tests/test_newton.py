"""Newton's method: optimum, penalty, scales, flat directions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from playthrough.plans import model, newton


def design(spark, x, y, weight):
    rows = [(list(map(float, a)), float(b), float(w)) for a, b, w in zip(x, y, weight)]
    return spark.createDataFrame(rows, "x array<double>, label double, weight double").repartition(3)


def gradient(x, y, weight, c, fitted):
    p = 1 / (1 + np.exp(-(x @ fitted.coefficients + fitted.intercept)))
    return x.T @ (weight * (p - y)) + fitted.coefficients / c, (weight * (p - y)).sum()


def sample(seed=0, n=400):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.normal(size=n), 5e11 + 1e11 * rng.normal(size=n), rng.integers(0, 2, n), 1990 + rng.integers(0, 30, n)], 1)
    z = x[:, 0] - (x[:, 1] - 5e11) / 1e11 + x[:, 2] - 0.05 * (x[:, 3] - 2005)
    return x, (z + rng.logistic(size=n) > 0).astype(float), rng.choice([0.5, 1.0, 3.0], n)


@pytest.mark.parametrize("c", [0.01, 1.0, 1e12])
def test_gradient_is_zero_whatever_the_scales(spark, c):
    x, y, weight = sample()
    fitted = newton.fit(design(spark, x, y, weight), c, tol=1e-14)
    assert fitted.converged and fitted.passes < 12
    by_feature, free = gradient(x, y, weight, c, fitted)
    assert np.abs(by_feature / (weight @ np.abs(x))).max() < 1e-9 and abs(free) / weight.sum() < 1e-9


def test_equal_and_constant_features(spark):
    """The penalty shares a weight between equal columns; a constant one gets none."""
    x, y, weight = sample(1)
    x = np.stack([x[:, 0], x[:, 0], x[:, 3], 2024 - x[:, 3], np.full(len(x), 7.0)], 1)
    fitted = newton.fit(design(spark, x, y, weight), 1.0, tol=1e-14)
    assert fitted.coefficients[0] == pytest.approx(fitted.coefficients[1], rel=1e-6)
    assert fitted.coefficients[2] == pytest.approx(-fitted.coefficients[3], rel=1e-6)
    assert fitted.coefficients[4] == 0
    by_feature, _ = gradient(x, y, weight, 1.0, fitted)
    assert np.abs(by_feature[:4]).max() < 1e-4


def test_separable_rows_stop(spark):
    x = np.arange(20.0)[:, None]
    fitted = newton.fit(design(spark, x, (x[:, 0] > 9).astype(float), np.ones(20)), 1e12, max_iter=15)
    assert fitted.passes <= 16 + newton.HALVINGS and np.isfinite(fitted.coefficients).all() and fitted.coefficients[0] > 1


def test_model_has_the_given_coefficients(spark):
    wanted = np.array([1e-13, -2.5, 0.0, 123456.789])
    built = model.with_coefficients(spark, wanted, -0.75)
    assert built.coefficients.toArray() == pytest.approx(wanted, rel=1e-12) and built.intercept == pytest.approx(-0.75)


def test_many_features_go_to_the_gradient_method(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 2))
    y = (x[:, 0] + rng.logistic(size=300) > 0).astype(float)
    rows = design(spark, x, y, np.ones(300)).select(
        model.F.col("label"), F.col("weight").alias("class_weight"), newton.array_to_vector("x").alias("features")
    )
    by_newton = model.regression(rows, 300)
    monkeypatch.setattr(newton, "MOST_FEATURES", 1)
    by_gradient = model.regression(rows, 300)
    assert by_newton.coefficients.toArray() == pytest.approx(by_gradient.coefficients.toArray(), abs=1e-4)


def test_tables_of_a_fit_are_removed(spark):
    from pathlib import Path

    from playthrough.sources.checkpoint import shared_folder

    x, y, weight = sample(3)
    rows = design(spark, x, y, weight).select("label", F.col("weight").alias("class_weight"), newton.array_to_vector("x").alias("features"))
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.glob("stored-*"))
    model.regression(rows, len(x))
    assert set(folder.glob("stored-*")) == before
