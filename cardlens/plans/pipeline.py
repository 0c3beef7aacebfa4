"""End-to-end batch job: sources -> features -> split -> train -> evaluate ->
select -> explain -> export. Run with spark-submit:

    spark-submit -m cardlens.plans.pipeline <raw_dir> <out_dir>

Only small values reach the driver: per-model metric rows (one aggregate
each), <=26 importances and the row counts of the split.
"""

from __future__ import annotations

import sys
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.config import CLASSIFICATION_THRESHOLD, TEST_SIZE, TOP_FEATURES_IN_SUMMARY
from cardlens.operators import evaluate, explain
from cardlens.operators import model as M
from cardlens.operators.enrich import prepare_transactions
from cardlens.operators.features import build_card_level_features
from cardlens.operators.materialize import materialize, run_folder
from cardlens.operators.split import split_train_test
from cardlens.session import get_session
from cardlens.sources import sinks
from cardlens.sources.tables import load_raw_data

_REPORT = "array<struct<class_name:string,precision:double,recall:double,f1_score:double,support:bigint>>"
METRICS_SCHEMA = (
    "model_name string, position int, accuracy double, precision double, recall double, f1 double, "
    "tp bigint, fp bigint, fn bigint, tn bigint, roc_auc double, "
    f"classification_report {_REPORT}"
)


def calculate_metrics(name: str, position: int, pred: DataFrame) -> DataFrame:
    """One row of :data:`METRICS_SCHEMA` for a scored frame (``y_true, y_pred,
    y_proba``); all of it from aggregates."""
    report = evaluate.classification_report(pred).agg(
        F.collect_list(F.struct("class_name", "precision", "recall", "f1_score", "support")).alias("r")
    )
    row = evaluate.binary_metrics(pred).first()
    auc = evaluate.roc_auc(pred).first()["roc_auc"]
    order = {n: i for i, n in enumerate(evaluate.REPORT_ROWS)}
    lines = sorted((tuple(x) for x in report.first()["r"]), key=lambda x: order[x[0]])
    values = [row[c] for c in ("accuracy", "precision", "recall", "f1", "tp", "fp", "fn", "tn")]
    return pred.sparkSession.createDataFrame([(name, position, *values, auc, lines)], METRICS_SCHEMA)


def compare(predictions: dict[str, DataFrame]) -> DataFrame:
    """Metrics of every candidate, in order, with ``is_best``."""
    rows = [calculate_metrics(name, i, pred) for i, (name, pred) in enumerate(predictions.items())]
    return M.mark_best(reduce(DataFrame.unionByName, rows))


def train_and_compare(spark: SparkSession, cards: DataFrame, exact_split: bool = True) -> dict:
    """Split, fit, compare, explain. By default every class gives exactly its share of test cards, which
    matters where cards are few; the hash split (``exact_split=False``) never moves a card when others
    come, and shuffles nothing."""
    train, test, cols = split_train_test(cards, exact=exact_split)
    models = M.train_models(train, cols)
    preds = {
        name: materialize(evaluate.predict_with_threshold(M.score_cards(m, test), CLASSIFICATION_THRESHOLD), "scores")
        for name, m in models.items()
    }
    metrics = compare(preds)
    best = metrics.filter("is_best").first()["model_name"]
    importance = explain.get_feature_importance(spark, models[best], cols)
    return {
        "train": train,
        "test": test,
        "feature_columns": cols,
        "models": models,
        "metrics": metrics,
        "predictions": preds,
        "best": best,
        "importance": importance,
    }


def summary_frame(
    metrics: DataFrame, importance: DataFrame, cols: list[str], train_cards: int, test_cards: int
) -> DataFrame:
    """The run's summary as one nested row: choice, settings, every candidate's metrics
    with its per-class report, and the most important features."""
    models = metrics.agg(
        F.max(F.when(F.col("is_best"), F.col("model_name"))).alias("best_model"),
        F.array_sort(F.collect_list(F.struct("position", *[c for c in metrics.columns if c != "position"]))).alias("models"),
    )
    top = explain.top_features(importance, TOP_FEATURES_IN_SUMMARY)
    top = top.agg(F.array_sort(F.collect_list(F.struct(*top.columns))).alias("top_features"))
    settings = {
        "selection_metric": F.lit("roc_auc"),
        "threshold": F.lit(CLASSIFICATION_THRESHOLD),
        "test_size": F.lit(TEST_SIZE),
        "train_cards": F.lit(train_cards).cast("long"),
        "test_cards": F.lit(test_cards).cast("long"),
        "feature_count": F.lit(len(cols)),
        "feature_columns": F.array(*map(F.lit, cols)),
    }
    return models.withColumn("top_features", top.scalar()).withColumns(settings)


def run_pipeline(spark: SparkSession, raw_dir: str, out_dir: str) -> dict:
    raw = load_raw_data(spark, raw_dir)
    # text dates by the format of their column, as the raw sources bring them
    prepared = prepare_transactions(
        raw["business_cards"], raw["consumer_cards"], raw["merchants_reference"], infer_datetimes=True
    )
    features_path = f"{out_dir}/processed/card_level_features.parquet"
    sinks.write_features(build_card_level_features(prepared), features_path)
    # the written table cuts the lineage: training re-reads features, not transactions
    cards = spark.read.parquet(features_path)
    run = train_and_compare(spark, cards)
    summary = summary_frame(
        run["metrics"], run["importance"], run["feature_columns"], run["train"].count(), run["test"].count()
    )
    sinks.write_summary(summary, f"{out_dir}/metrics/metrics.json")
    sinks.save_predictions(run["predictions"][run["best"]], f"{out_dir}/predictions/test_predictions.csv")
    sinks.save_model(run["models"][run["best"]], f"{out_dir}/models/model")
    return run


def main(argv: list[str]) -> int:
    if len(argv) != 3:
        print("usage: pipeline.py <raw_dir> <out_dir>", file=sys.stderr)
        return 2
    spark = get_session(app_name="cardlens-pipeline")
    try:
        with run_folder(spark):
            best = run_pipeline(spark, argv[1], argv[2])["best"]
    except FileNotFoundError as missing:
        print(f"pipeline: {missing}", file=sys.stderr)
        return 1
    print(f"chosen: {best}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
