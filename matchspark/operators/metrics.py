"""Classifier metrics on long-form predictions.

Predictions are kept as rows ``(model, y, prediction)``; every metric of
every model comes out of ONE ``groupBy(model)`` aggregate with partial
aggregation — four counters per model, whatever the row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import ACCURACY_TARGET


def _ratio(num, den):
    """``num / den`` as double, 0 when ``den`` is 0 (``zero_division=0``)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def confusion(df: DataFrame, y: str = "y", pred: str = "prediction", by=("model",)) -> DataFrame:
    """Always 2x2 — tn, fp, fn, tp (rows actual, columns predicted)."""
    a, p = F.col(y), F.col(pred)
    return df.groupBy(*by).agg(
        F.count_if((a == 0) & (p == 0)).alias("tn"),
        F.count_if((a == 0) & (p == 1)).alias("fp"),
        F.count_if((a == 1) & (p == 0)).alias("fn"),
        F.count_if((a == 1) & (p == 1)).alias("tp"))


def add_metrics(cm: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1 of class 1 from the counters."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return cm.withColumns({
        "accuracy": _ratio(tp + tn, tn + fp + fn + tp),
        "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn),
        "f1_score": _ratio(F.lit(2) * tp, F.lit(2) * tp + fp + fn),
    })


def model_comparison(df: DataFrame, y: str = "y", pred: str = "prediction", model: str = "model",
                     target: float = ACCURACY_TARGET) -> DataFrame:
    """One row per model with the four metrics and the target flag."""
    m = add_metrics(confusion(df, y, pred, by=(model,)))
    return (m.withColumn("meets_target", F.col("accuracy") >= F.lit(target))
             .select(F.col(model).alias("model_name"), "accuracy", "precision", "recall", "f1_score",
                     "meets_target"))


def metric_report(df: DataFrame, y: str = "y", pred: str = "prediction", model: str = "model") -> DataFrame:
    """Metrics, matrix cells and rounded percentages per model."""
    m = add_metrics(confusion(df, y, pred, by=(model,)))
    pct = {f"{c}_pct": F.bround(F.col(c) * F.lit(100.0), 2) for c in ("accuracy", "precision", "recall", "f1_score")}
    return m.withColumns(pct).withColumnRenamed(model, "model_name")


def predicted_wins(df: DataFrame, pred: str = "prediction", model: str = "model") -> DataFrame:
    """A5: predicted team1 wins and games per model."""
    return df.groupBy(model).agg(F.sum(F.col(pred).cast("long")).alias("team1_wins"),
                                 F.count(F.lit(1)).alias("games"))
