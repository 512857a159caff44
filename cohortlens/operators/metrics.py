"""Evaluation metrics as aggregates: purity, confusion matrix, binary metrics, ROC/AUC,
running weighted averages.  Nothing is collected; every result is a small DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .indexing import scan_sums


def purity(assignments: DataFrame, cluster: str = "cluster", cls: str = "class") -> DataFrame:
    """Σ_k max_j n_kj / N over (cluster, class) rows, as a one-row frame (purity)."""
    counts = assignments.groupBy(cluster, cls).agg(F.count(F.lit(1)).alias("n"))
    per = counts.groupBy(cluster).agg(F.max("n").alias("best"), F.sum("n").alias("size"))
    return per.agg((F.sum("best") / F.sum("size")).alias("purity"))


def confusion_matrix(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Long form (y_true, y_pred, n, fraction) with fraction = n / row total (row-normalised)."""
    counts = df.groupBy(y_true, y_pred).agg(F.count(F.lit(1)).alias("n"))
    rows = counts.groupBy(y_true).agg(F.sum("n").alias("_row"))
    return counts.join(rows, y_true).select(y_true, y_pred, "n", (F.col("n") / F.col("_row")).alias("fraction"))


def binary_metrics(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """One row: tp, fp, fn, tn, accuracy, precision, recall, f1 (standard orientation;
    undefined ratios are null)."""
    t, p = F.col(y_true) == 1, F.col(y_pred) == 1
    c = df.agg(
        F.count(F.when(t & p, 1)).alias("tp"), F.count(F.when(~t & p, 1)).alias("fp"),
        F.count(F.when(t & ~p, 1)).alias("fn"), F.count(F.when(~t & ~p, 1)).alias("tn"))
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    prec, rec = F.try_divide(tp, tp + fp), F.try_divide(tp, tp + fn)
    return c.select("tp", "fp", "fn", "tn",
                    F.try_divide(tp + tn, tp + fp + fn + tn).alias("accuracy"),
                    prec.alias("precision"), rec.alias("recall"),
                    F.try_divide(2 * prec * rec, prec + rec).alias("f1"))


def _score_groups(df: DataFrame, y_true: str, score: str) -> DataFrame:
    """One row per distinct score: positives and negatives at that score."""
    return df.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(F.when(F.col(y_true) == 1, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(y_true) == 1, 0).otherwise(1)).alias("neg"))


def roc_curve(df: DataFrame, y_true: str = "y_true", score: str = "score") -> DataFrame:
    """(threshold, tpr, fpr): one point per distinct score, predicting positive when
    score >= threshold.  Cumulative counts come from distributed prefix sums."""
    g = _score_groups(df, y_true, score)
    p_tot, n_tot = g.agg(F.sum("pos")).scalar(), g.agg(F.sum("neg")).scalar()
    cum = scan_sums(g, [F.col("threshold").desc()], ["pos", "neg"])
    return cum.select("threshold", F.try_divide(F.col("pos_cum"), p_tot.cast("double")).alias("tpr"),
                      F.try_divide(F.col("neg_cum"), n_tot.cast("double")).alias("fpr"))


def roc_auc(df: DataFrame, y_true: str = "y_true", score: str = "score") -> DataFrame:
    """Area under the ROC curve (ties count one half): Σ pos_s·(neg_below_s + neg_s/2) / (P·N)."""
    g = _score_groups(df, y_true, score)
    below = scan_sums(g, ["threshold"], ["neg"], inclusive=False, suffix="_below")
    return below.agg(F.try_divide(F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0)),
                                  F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))


def running_weighted_average(df: DataFrame, order_cols: list, value: str, weight: str) -> DataFrame:
    """Adds running_avg = Σ value·weight / Σ weight over rows up to the current one."""
    base = df.withColumn("_vw", F.col(value) * F.col(weight)).withColumn("_w", F.col(weight).cast("double"))
    cum = scan_sums(base, order_cols, ["_vw", "_w"])
    return cum.withColumn("running_avg", F.try_divide(F.col("_vw_cum"), F.col("_w_cum"))).drop(
        "_vw", "_w", "_vw_cum", "_w_cum")
