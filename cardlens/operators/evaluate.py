"""Threshold, confusion matrix, metrics, report and ROC AUC on a scored frame.

Input: any frame with ``y_true`` (0/1), ``y_proba`` (score) and optionally
``y_pred``. Every metric is one aggregation; only one-row results come back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.config import CLASS_NAMES, CLASSIFICATION_THRESHOLD
from cardlens.operators.materialize import materialize
from cardlens.operators.selection import pairs_below


def predict_with_threshold(scored: DataFrame, threshold: float = CLASSIFICATION_THRESHOLD) -> DataFrame:
    return scored.withColumn("y_pred", (F.col("y_proba") >= F.lit(threshold)).cast("int"))


def _safe_div(num: Column, den: Column) -> Column:
    """num / den, 0.0 when den is 0 (zero_division=0)."""
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def confusion_counts(pred: DataFrame) -> DataFrame:
    """One row: tp, fp, fn, tn (as longs)."""
    t, p = F.col("y_true"), F.col("y_pred")
    return pred.agg(
        F.count_if((t == 1) & (p == 1)).alias("tp"),
        F.count_if((t == 0) & (p == 1)).alias("fp"),
        F.count_if((t == 1) & (p == 0)).alias("fn"),
        F.count_if((t == 0) & (p == 0)).alias("tn"),
    )


def confusion_matrix(pred: DataFrame) -> DataFrame:
    """Cells (y_true, y_pred, n) over labels [0, 1]; empty cells are 0."""
    c = confusion_counts(pred)
    cells = F.array(
        *[
            F.struct(F.lit(yt).alias("y_true"), F.lit(yp).alias("y_pred"), F.col(name).alias("n"))
            for yt, yp, name in [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
        ]
    )
    return c.select(F.inline(cells))


def binary_metrics(pred: DataFrame) -> DataFrame:
    c = confusion_counts(pred)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    precision = _safe_div(tp, tp + fp)
    recall = _safe_div(tp, tp + fn)
    return c.select(
        "tp", "fp", "fn", "tn",
        _safe_div(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


# order of the report
REPORT_ROWS = (*CLASS_NAMES, "accuracy", "macro avg", "weighted avg")


def classification_report(pred: DataFrame) -> DataFrame:
    """Per class precision/recall/f1/support, then accuracy, macro and weighted
    averages; the accuracy row carries accuracy in ``f1_score``."""
    c = confusion_counts(pred)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    total = tp + fp + fn + tn
    # class 1 = positive, class 0 = negative (its tp is tn, etc.)
    p1, r1, f1 = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn), _safe_div(2 * tp, 2 * tp + fp + fn)
    p0, r0, f0 = _safe_div(tn, tn + fn), _safe_div(tn, tn + fp), _safe_div(2 * tn, 2 * tn + fn + fp)
    s1, s0 = tp + fn, tn + fp

    def row(name, p, r, f, s):
        return F.struct(
            F.lit(name).alias("class_name"),
            p.cast("double").alias("precision"),
            r.cast("double").alias("recall"),
            f.cast("double").alias("f1_score"),
            s.cast("long").alias("support"),
        )

    rows = F.array(
        row(CLASS_NAMES[0], p0, r0, f0, s0),
        row(CLASS_NAMES[1], p1, r1, f1, s1),
        row("accuracy", F.lit(None), F.lit(None), _safe_div(tp + tn, total), total),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, total),
        row(
            "weighted avg",
            _safe_div(p0 * s0 + p1 * s1, total),
            _safe_div(r0 * s0 + r1 * s1, total),
            _safe_div(f0 * s0 + f1 * s1, total),
            total,
        ),
    )
    return c.select(F.inline(rows))


def roc_auc(scored: DataFrame) -> DataFrame:
    """Exact ROC AUC (ties count one half, rows without a score are left out); null unless both classes occur.

    Scores are pre-aggregated to one row per distinct score (written once); the pairs of a positive
    above a negative are counted by :func:`pairs_below`, which sorts no more than a
    bounded number of scores in a task.
    """
    by_score = scored.groupBy(F.col("y_proba").cast("double").alias("_v")).agg(
        F.count_if(F.col("y_true") == 1).alias("_pos"),
        F.count_if(F.col("y_true") != 1).alias("_neg"),
    )
    by_score = materialize(by_score.filter("_v IS NOT NULL"), "scores")
    wins = pairs_below(by_score)
    sums = by_score.agg(F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n"))
    return sums.select(
        F.when(
            (F.col("_p") > 0) & (F.col("_n") > 0),
            F.lit(wins) / (F.col("_p").cast("double") * F.col("_n").cast("double")),
        ).alias("roc_auc")
    )
