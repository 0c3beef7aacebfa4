"""Sinks: features (parquet), ranked predictions (CSV), run summary (JSON),
model artifact (Spark ML format). Paths must be on shared storage."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_features(cards: DataFrame, path: str) -> None:
    """Card features ordered by card number (range-partitioned sort of the
    card-level rows, so part files are in order)."""
    cards.orderBy("card_number").write.mode("overwrite").parquet(path)


def save_predictions(pred: DataFrame, path: str) -> None:
    """Predictions sorted by score, descending (ties by card).

    The global sort range-partitions the rows, so part files are in order
    and concatenate to one sorted CSV without funnelling rows into one task.
    """
    (
        pred.select("card_number", "y_true", "y_pred", "y_proba")
        .orderBy(F.desc("y_proba"), F.asc("card_number"))
        .write.mode("overwrite")
        .option("header", True)
        .csv(path)
    )


def write_summary(summary: DataFrame, path: str) -> None:
    """One-row nested summary as a single JSON document."""
    summary.coalesce(1).write.mode("overwrite").json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
