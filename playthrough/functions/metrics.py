"""Binary classification metrics from a scored DataFrame.

Everything starts from counts: the four cells of the confusion matrix, or positives and negatives
per distinct score. The counts are exact and combine before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playthrough.functions.scalar import RATIO_SCALE
from playthrough.operators.ordering import running_sums


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / whole)


def classification_report(predicted: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, and their averages; 0 where undefined.

    The accuracy row holds the accuracy in all three columns.
    """
    cells = {
        f"{name}{i}": F.count_if((F.col(label) == a) & (F.col(prediction) == p))
        for i, (name, a, p) in enumerate([("n", 0, 0), ("n", 0, 1), ("n", 1, 0), ("n", 1, 1)])
    }
    tn, fp, fn, tp = (F.col(c) for c in cells)
    counts = predicted.agg(*[v.alias(c) for c, v in cells.items()])

    def scores(hit: Column, false_hit: Column, missed: Column) -> tuple[Column, Column, Column, Column]:
        return (
            _share(hit, hit + false_hit),
            _share(hit, hit + missed),
            _share(2 * hit, 2 * hit + false_hit + missed),
            hit + missed,
        )

    def row(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1_score"),
            support.alias("support"),
        )

    zero, one = scores(tn, fn, fp), scores(tp, fp, fn)
    total = tn + fp + fn + tp
    accuracy = _share(tn + tp, total)
    macro = [(a + b) / 2 for a, b in zip(zero[:3], one[:3])]
    weighted = [_share(a * zero[3] + b * one[3], total) for a, b in zip(zero[:3], one[:3])]
    rows = F.array(
        row("0", *zero),
        row("1", *one),
        row("accuracy", accuracy, accuracy, accuracy, total),
        row("macro avg", *macro, total),
        row("weighted avg", *weighted, total),
    )
    return counts.select(F.inline(rows))


def score_curve(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row per distinct score: its positives and negatives (``pos``, ``neg``), those at or above
    it (``tp``, ``fp``), all of them (``p``, ``n``), and the counts of the next lower score."""
    by_score = (
        scored.filter(F.col(score).isNotNull())
        .groupBy(F.col(score).alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
        .withColumn("_down", -F.col("score"))
    )
    curve = running_sums(
        by_score,
        "_down",
        sums={"tp": "pos", "fp": "neg"},
        totals={"p": "pos", "n": "neg"},
        ahead={"next_pos": "pos", "next_neg": "neg"},
    )
    return curve.drop("_down")


def roc_curve(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return roc_curve_of(score_curve(scored, label, score))


def roc_curve_of(curve: DataFrame) -> DataFrame:
    """Points from (0, 0), whose threshold is null, down to the lowest score.

    A point on the straight line between its neighbours is left out, as the curve stays the same.
    """
    bends = F.col("next_pos").isNull() | (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
    is_top = F.col("tp") + F.col("fp") == F.col("pos") + F.col("neg")
    points = curve.filter(bends | is_top).select(
        F.col("score").alias("threshold"),
        _share(F.col("fp"), F.col("n")).alias("fpr"),
        _share(F.col("tp"), F.col("p")).alias("tpr"),
    )
    return points.union(_anchor(points, fpr=0.0, tpr=0.0))


def pr_curve(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return pr_curve_of(score_curve(scored, label, score))


def pr_curve_of(curve: DataFrame) -> DataFrame:
    """Precision and recall at every score, and the end point (1, 0), whose threshold is null."""
    points = curve.select(
        F.col("score").alias("threshold"),
        _share(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _share(F.col("tp"), F.col("p")).alias("recall"),
    )
    return points.union(_anchor(points, precision=1.0, recall=0.0))


def _anchor(points: DataFrame, **values: float) -> DataFrame:
    return points.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), *[F.lit(v).alias(c) for c, v in values.items()]
    )


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return roc_auc_of(score_curve(scored, label, score))


def roc_auc_of(curve: DataFrame) -> DataFrame:
    """Area under the ROC curve: the share of (positive, negative) pairs ranked rightly, ties half.

    Counted in integers, so exact up to the final division.
    """
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ["neg", "tp", "pos"]}
    twice = F.sum(wide["neg"] * (2 * wide["tp"] - wide["pos"]))
    pairs = F.max("p").cast("double") * F.max("n")
    return curve.agg((twice.cast("double") / 2 / pairs).alias("roc_auc"))


def average_precision(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return average_precision_of(score_curve(scored, label, score))


def average_precision_of(curve: DataFrame) -> DataFrame:
    """Sum over scores of the gain in recall times the precision, which is kept to 1e-9."""
    precision = F.floor(F.col("tp").cast("double") / (F.col("tp") + F.col("fp")) * RATIO_SCALE)
    total = F.sum(F.col("pos").cast("decimal(19,0)") * precision.cast("decimal(10,0)"))
    return curve.agg((total.cast("double") / RATIO_SCALE / F.max("p")).alias("average_precision"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """n / (2 * n_class) for each of the two classes."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n_rows"))
    everyone = F.sum("n_rows").over(Window.partitionBy())  # of two rows
    weight = everyone.cast("double") / (2 * F.col("n_rows"))
    return counts.select("label", "n_rows", weight.alias("weight"))
