"""Measured quality of a classifier against ground truth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pct_tenths(correct, n):
    """100 * correct / n rounded half-up to one decimal, in exact integer arithmetic."""
    return ((F.lit(2000) * correct + n).cast("long") / (F.lit(2) * n)).cast("long") / F.lit(10.0)


def accuracy(pred: DataFrame, actual: str, predicted: str,
             group_by: Sequence[str] = ()) -> DataFrame:
    """N, correct, accuracy_pct.  A NULL prediction counts as wrong (trap #15)."""
    agg = (pred.groupBy(*group_by) if group_by else pred.groupBy()).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(predicted) == F.col(actual)).alias("correct"))
    return agg.withColumn("accuracy_pct", pct_tenths(F.col("correct"), F.col("n")))


def confusion_misses(pred: DataFrame, actual: str, predicted: str) -> DataFrame:
    """(actual, predicted, misses) where they differ; a NULL prediction is absent."""
    return (pred.filter(F.col(predicted) != F.col(actual))
            .groupBy(actual, predicted).agg(F.count(F.lit(1)).alias("misses"))
            .orderBy(F.col("misses").desc(), actual, predicted))


def confusion_matrix(pred: DataFrame, actual: str, predicted: str,
                     labels: Sequence[str]) -> DataFrame:
    """Full matrix: one row per actual label, one column per predicted label (pivot with
    the label list given, so no extra pass to discover the values)."""
    return (pred.groupBy(actual).pivot(predicted, list(labels))
            .agg(F.count(F.lit(1))).na.fill(0))


def flag_overlap(df: DataFrame, flag: str, label: str, positive: Sequence[str]) -> DataFrame:
    """Rows flagged, and how many of those carry a label from ``positive``."""
    f = df.filter(F.col(flag))
    return f.agg(F.count(F.lit(1)).alias("flagged_by_ai_filter"),
                 F.count_if(F.col(label).isin(*positive)).alias("of_those_labeled_fraud_like"))
