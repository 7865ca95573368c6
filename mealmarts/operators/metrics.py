"""Evaluation of scored rows as plain aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: scores from here on count as class 1.
THRESHOLD = 0.5


def to_class(score: str | Column, threshold: float = THRESHOLD) -> Column:
    value = F.col(score) if isinstance(score, str) else score
    return F.when(value >= threshold, 1).otherwise(0)


def share(part: Column, whole: Column) -> Column:
    """0 where the whole is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / F.when(whole != 0, whole))


def binary_metrics(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1; a zero denominator gives 0."""
    y, p = F.col(label), F.col(predicted)
    n = df.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return n.select(
        *[F.col(c) for c in ("tp", "fp", "fn", "tn")],
        share(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
    )


def rmse(df: DataFrame, label: str, score: str) -> DataFrame:
    return df.agg(F.sqrt(F.avg(F.pow(F.col(score) - F.col(label), 2))).alias("rmse"))
