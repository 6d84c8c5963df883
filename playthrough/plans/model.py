"""Training, evaluation and batch scoring of the completion model with MLlib and Newton's method.

The input is a stored feature table: training passes over it several times.
"""

from __future__ import annotations

import functools
import uuid

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import (
    FeatureHasher,
    Imputer,
    ImputerModel,
    OneHotEncoder,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Matrices, Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playthrough.functions import metrics
from playthrough.operators.ordering import chronological_split
from playthrough.plans import newton
from playthrough.sources.checkpoint import materialize, remove, shared_folder, stored

NOT_FEATURES = ["event_id", "event_ts", "is_completion", "user_genre_preference"]
PROBABILITY = "predicted_completion_probability"
#: Features that are written as one expression each, at most; beyond, MLlib's vectors are used.
PLAIN_FEATURES = 400


def split_by_type(schema: T.StructType) -> tuple[list[str], list[str]]:
    """Numeric and other feature columns, in table order."""
    fields = [f for f in schema.fields if f.name not in NOT_FEATURES]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    return numeric, [f.name for f in fields if f.name not in numeric]


def without_empty(df: DataFrame, columns: list[str]) -> list[str]:
    """Columns with at least one value: neither a mean nor a category comes from the others."""
    found = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    return [c for c in columns if found[c] > 0]


def typed(df: DataFrame, numeric: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in numeric})


def one_hot_column(name: str) -> str:
    return f"{name}__onehot"


def one_hot_stages(categorical: list[str]) -> list:
    """A 0/1 vector per column, one place per category; null and unknown categories are all zeros."""
    if not categorical:
        return []
    indexed = [f"{name}__index" for name in categorical]
    return [
        StringIndexer(inputCols=categorical, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=indexed, outputCols=[one_hot_column(name) for name in categorical], dropLast=True),
    ]


def one_hot_names(indexer: StringIndexerModel) -> list[str]:
    """Names of the places of all vectors, in order."""
    return [f"{c}_{label}" for c, labels in zip(indexer.getInputCols(), indexer.labelsArray) for label in labels]


def one_hot_totals(df: DataFrame, categorical: list[str]) -> DataFrame:
    """How many rows have each 0/1 feature set."""
    fitted = Pipeline(stages=one_hot_stages(categorical)).fit(df)
    sums = [Summarizer.sum(F.col(one_hot_column(c))).alias(c) for c in categorical]
    found = fitted.transform(df).agg(*sums).first()
    counts = [int(n) for c in categorical for n in found[c].toArray()]
    data = list(zip(one_hot_names(fitted.stages[0]), counts, strict=True))
    return df.sparkSession.createDataFrame(data, "feature string, n_rows bigint")


HASHED = "_hashed"


def feature_stages(numeric: list[str], categorical: list[str], hashed: int | None = None) -> list:
    """Impute means, one-hot all categories, everything in one vector.

    A category that is null or unknown gives zeros in all its columns. The list of known categories is fitted and
    kept by the driver. With ``hashed`` there is no such list: every category of any column has one of so many
    places by its hash, which it may share with others.
    """
    filled = [f"{name}__filled" for name in numeric]
    stages = [Imputer(strategy="mean", inputCols=numeric, outputCols=filled)] if numeric else []
    if hashed is not None and categorical:
        stages.append(FeatureHasher(inputCols=categorical, categoricalCols=categorical, outputCol=HASHED, numFeatures=hashed))
        assembled = [*filled, HASHED]
    else:
        stages += one_hot_stages(categorical)
        assembled = filled + [one_hot_column(name) for name in categorical]
    return [*stages, VectorAssembler(inputCols=assembled, outputCol="features")]


def with_coefficients(spark: SparkSession, coefficients: np.ndarray, intercept: float) -> LogisticRegressionModel:
    """A model of given coefficients: bounds from both sides leave no other. Two rows stand for the features."""
    p = len(coefficients)
    exactly = Matrices.dense(1, p, coefficients.tolist())
    free = Vectors.dense([intercept])
    corners = [(0.0, Vectors.dense([0.0] * p)), (1.0, Vectors.dense([1.0] * p))]
    fixed = LogisticRegression(
        labelCol="label",
        family="binomial",
        standardization=False,
        maxIter=0,
        lowerBoundsOnCoefficients=exactly,
        upperBoundsOnCoefficients=exactly,
        lowerBoundsOnIntercepts=free,
        upperBoundsOnIntercepts=free,
    )
    return fixed.fit(spark.createDataFrame(corners, ["label", "features"]))


def regression(rows: DataFrame, n_rows: int, c: float = 1.0, max_iter: int = 100, tol: float = 1e-9) -> LogisticRegressionModel:
    """Logistic regression with an L2 penalty on rows with ``features``, ``label`` and ``class_weight``.

    ``c`` is the weight of the summed losses against the penalty. The intercept is not penalised, features are not
    scaled before penalising. Newton's method needs a few passes over the data; with so many features that the
    matrix of their products is too large, MLlib's gradient method takes up to ``max_iter``. There losses are
    averaged, and balanced weights add up to the number of rows.
    """
    if rows.select("features").first()["features"].size <= newton.MOST_FEATURES:
        return by_newton(rows, vector_to_array("features"), c, max_iter, tol)
    by_gradient = LogisticRegression(
        labelCol="label", weightCol="class_weight", regParam=1.0 / (c * n_rows), elasticNetParam=0.0, standardization=False,
        maxIter=max_iter, tol=tol,
    )
    return by_gradient.fit(rows)


def by_newton(rows: DataFrame, x: Column, c: float = 1.0, max_iter: int = 100, tol: float = 1e-9) -> LogisticRegressionModel:
    """``regression`` by Newton's method, of features in an array."""
    design = stored(rows.select(x.alias("x"), "label", F.col("class_weight").alias("weight")))
    try:
        found = newton.fit(design, c, max_iter, tol)
    finally:
        remove(design)
    return with_coefficients(rows.sparkSession, found.coefficients, found.intercept)


def plain_features(stages: list) -> list[Column] | None:
    """What the fitted stages put in the vector, as column expressions; None for hashed or very many features.

    The stages' own functions take rows apart and put them together again, one after the other.
    """
    columns = []
    for stage in stages:
        if isinstance(stage, ImputerModel):
            means = stage.surrogateDF.first()
            for name in stage.getInputCols():
                value = F.col(name).cast("double")
                columns.append(F.when(value.isNull() | F.isnan(value), means[name]).otherwise(value))
        elif isinstance(stage, StringIndexerModel):
            for name, labels in zip(stage.getInputCols(), stage.labelsArray):
                columns += [F.when(F.col(name).cast("string") == label, 1.0).otherwise(0.0) for label in labels]
        elif isinstance(stage, FeatureHasher):
            return None
    return columns if 0 < len(columns) <= PLAIN_FEATURES else None


def labelled(features: DataFrame) -> DataFrame:
    return features.withColumn("label", F.col("is_completion").cast("double"))


def balanced(rows: DataFrame) -> tuple[DataFrame, int]:
    """Rows with balanced class weights, and their number."""
    weights = {r["label"]: r for r in metrics.class_weights(rows).collect()}  # two rows
    column = F.lit(None).cast("double")
    for label, r in weights.items():
        column = F.when(F.col("label") == label, r["weight"]).otherwise(column)
    return rows.withColumn("class_weight", column), sum(r["n_rows"] for r in weights.values())


def fit(
    train: DataFrame, impute_from: DataFrame | None = None, hashed: int | None = None, **options: float
) -> PipelineModel:
    """Fit on labelled rows; ``options`` are ``c``, ``max_iter`` and ``tol`` of ``regression``.

    Means are fitted on the training rows. ``impute_from`` fits them on other rows instead, for
    instance on training and test rows together. ``hashed`` is that of ``feature_stages``.
    """
    numeric, categorical = split_by_type(train.drop("label").schema)
    usable = set(without_empty(train, numeric + categorical))
    numeric, categorical = ([c for c in cols if c in usable] for cols in (numeric, categorical))
    rows, n = balanced(typed(train, numeric))
    stages = feature_stages(numeric, categorical, hashed)
    if impute_from is not None and numeric:
        stages = [stages[0].fit(typed(impute_from, numeric)), *stages[1:]]
    prepared = Pipeline(stages=stages).fit(rows)
    plain = plain_features(prepared.stages)
    if plain is None:
        fitted = regression(prepared.transform(rows), n, **options)
    else:
        fitted = by_newton(rows, F.array(*plain), **options)
    return stored_copy(PipelineModel([*prepared.stages, fitted]), train.sparkSession)


def stored_copy(model: PipelineModel, spark: SparkSession) -> PipelineModel:
    """The model as read back from storage.

    A freshly fitted one drags its training summary, and with it the session, into every task;
    that fails once the session has observed metrics.
    """
    path = f"{shared_folder(spark)}/model-{uuid.uuid4().hex}"
    save(model, path)
    return load(path)


def imputed_means(train: DataFrame) -> DataFrame:
    """Mean of every numeric feature that has a value: what stands in for its nulls."""
    numeric, _ = split_by_type(train.drop("label").schema)
    numeric = without_empty(train, numeric)
    fitted = Imputer(strategy="mean", inputCols=numeric, outputCols=[f"{c}__filled" for c in numeric])
    means = fitted.fit(typed(train, numeric)).surrogateDF.select(*numeric)
    return means.unpivot([], numeric, "feature", "mean")


def model_inputs(model: PipelineModel) -> tuple[list[str], list[str]]:
    """Numeric and categorical input columns of a fitted model."""
    numeric, categorical = [], []
    for stage in model.stages:
        if isinstance(stage, ImputerModel):
            numeric = list(stage.getInputCols())
        elif isinstance(stage, (StringIndexerModel, FeatureHasher)):
            categorical = list(stage.getInputCols())
    return numeric, categorical


def apply(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Rows with ``prediction`` (0 or 1) and the probability of completion."""
    plain = plain_features(model.stages[:-1])
    if plain is not None:
        regression = model.stages[-1]
        terms = [F.lit(regression.intercept), *[x * float(w) for x, w in zip(plain, regression.coefficients.toArray(), strict=True)]]
        while len(terms) > 1:  # in pairs, for a shallow expression
            terms = [a + b for a, b in zip(terms[::2], terms[1::2])] + (terms[-1:] if len(terms) % 2 else [])
        rows = features.withColumn(PROBABILITY, 1 - 1 / (1 + F.exp(terms[0])))
        prediction = F.when(F.col(PROBABILITY) > regression.getThreshold(), 1).otherwise(0).alias("prediction")
        return rows.select(*features.columns, prediction, PROBABILITY)
    numeric, _ = model_inputs(model)
    scored = model.transform(typed(features, numeric))
    probability = F.get(vector_to_array("probability"), F.lit(1))
    return scored.select(*features.columns, F.col("prediction").cast("int"), probability.alias(PROBABILITY))


def score(model: PipelineModel, features: DataFrame) -> DataFrame:
    return apply(model, features).select("event_id", PROBABILITY)


def align(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Give any table the columns a model was trained on.

    A missing number is 0, a missing category none of the known ones, further columns are left
    out, nulls in numbers are 0.
    """
    numeric, categorical = model_inputs(model)
    columns = [
        F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) if c in df.columns else F.lit(0.0).alias(c)
        for c in numeric
    ]
    columns += [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in categorical]
    return df.select("event_id", *columns).dropna(subset=numeric or None)


def coefficients(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Name and weight of every feature, in model order."""
    numeric, _ = model_inputs(model)
    regression = model.stages[-1]
    names = list(numeric)
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            names += one_hot_names(stage)
        elif isinstance(stage, FeatureHasher):
            names += [f"hashed_{k}" for k in range(stage.getNumFeatures())]
    data = [(i, n, float(w)) for i, (n, w) in enumerate(zip(names, regression.coefficients.toArray(), strict=True))]
    return spark.createDataFrame(data, "position int, feature string, coefficient double")


class Evaluation:
    """Metrics of applied rows with a ``label``, each made when it is asked for."""

    def __init__(self, predicted: DataFrame):
        self._predicted = predicted

    @functools.cached_property
    def _curve(self) -> DataFrame:
        """Counts per score and what lies above: sorted once, for all metrics of the ranking."""
        return metrics.score_curve(self._predicted.withColumn("score", F.col(PROBABILITY)))

    @property
    def report(self) -> DataFrame:
        return metrics.classification_report(self._predicted)

    @property
    def roc_auc(self) -> DataFrame:
        return metrics.roc_auc_of(self._curve)

    @property
    def average_precision(self) -> DataFrame:
        return metrics.average_precision_of(self._curve)

    @property
    def roc_curve(self) -> DataFrame:
        return metrics.roc_curve_of(self._curve)

    @property
    def pr_curve(self) -> DataFrame:
        return metrics.pr_curve_of(self._curve)


def split(features: DataFrame, test_size: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Labelled rows: the oldest for training, the newest for testing."""
    return chronological_split(labelled(features), test_size)


def evaluate_on(model: PipelineModel, test: DataFrame) -> Evaluation:
    """Apply the model once and derive all metrics from that."""
    return Evaluation(materialize(apply(model, test).select("label", "prediction", PROBABILITY)))


def train_and_evaluate(features: DataFrame, test_size: float = 0.2) -> tuple[PipelineModel, Evaluation]:
    train, test = split(features, test_size)
    model = fit(train)
    return model, evaluate_on(model, test)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
