"""Classifier metrics as DataFrame aggregates; no model object needed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playerlens.functions.columns import ratio
from playerlens.operators.ranking import global_running_totals
from playerlens.settings import ChurnSettings


def _ranked(df: DataFrame, label: str, probability: str) -> DataFrame:
    """One row per distinct probability, with its labels and the rows below it."""
    histogram = df.groupBy(F.col(probability).alias("p")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col(label).cast("bigint")).alias("positives"),
        F.count_if(F.col(label) == 1).alias("ones"),
        F.count_if(F.col(label) != 1).alias("others"),
    )
    return global_running_totals(histogram, ["p"], {"below": "rows"})


def _auc() -> Column:
    """Over the rows of ``_ranked``, from mean ranks; NULL with a single class."""
    mean_rank = F.col("below") + (F.col("rows") + 1) / 2.0
    positives = F.sum("positives").cast("double")
    negatives = F.sum("rows").cast("double") - positives
    rank_sum = F.sum(F.col("positives") * mean_rank)
    return ratio(rank_sum - positives * (positives + 1) / 2, positives * negatives)


def auc(df: DataFrame, label: str, probability: str) -> DataFrame:
    """Area under the ROC curve in one row; NULL with a single class."""
    return _ranked(df, label, probability).agg(_auc().alias("auc_roc"))


def binary_metrics(
    df: DataFrame, label: str, probability: str, threshold: float = 0.5
) -> DataFrame:
    """AUC, F1, precision, recall, accuracy, confusion counts, size and positive rate: one row.

    Precision, recall and F1 are 0 where their denominator is. Everything comes from the histogram
    by probability, so ``df`` is read once. Rows without a label or probability are not in the counts.
    """
    said = F.col("p") >= threshold

    def counted(which: str, where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col(which))), F.lit(0))

    counts = _ranked(df, label, probability).agg(
        _auc().alias("auc_roc"),
        counted("others", ~said).alias("true_negatives"),
        counted("others", said).alias("false_positives"),
        counted("ones", ~said).alias("false_negatives"),
        counted("ones", said).alias("true_positives"),
    )
    tn, fp, fn, tp = (
        F.col(c)
        for c in ("true_negatives", "false_positives", "false_negatives", "true_positives")
    )
    size = tn + fp + fn + tp

    def or_zero(numerator, denominator):
        return F.coalesce(ratio(numerator, denominator), F.lit(0.0))

    return counts.select(
        "auc_roc",
        or_zero(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        or_zero(tp, tp + fp).alias("precision"),
        or_zero(tp, tp + fn).alias("recall"),
        ratio(tp + tn, size).alias("accuracy"),
        tn,
        fp,
        fn,
        tp,
        size.alias("test_size"),
        ratio(tp + fn, size).alias("churn_rate"),
    )


def passes_gates(metrics: DataFrame, settings: ChurnSettings = ChurnSettings()) -> DataFrame:
    """Metrics with a verdict per gate and overall; an undefined metric fails."""

    def reaches(column: str, least: float):
        return F.coalesce(F.col(column) >= least, F.lit(False))

    return metrics.withColumns(
        {
            "precision_ok": reaches("precision", settings.min_precision),
            "recall_ok": reaches("recall", settings.min_recall),
            "auc_ok": reaches("auc_roc", settings.min_auc),
        }
    ).withColumn("passed", F.col("precision_ok") & F.col("recall_ok") & F.col("auc_ok"))
