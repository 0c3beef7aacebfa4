import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cardlens.operators import model as M
from cardlens.operators.split import split_train_test
from cardlens.sources import sinks
from cardlens.sources.tables import load_raw_data


def _cards(spark, n=400):
    # separable: business cards have larger amounts and more merchants
    df = spark.range(n).select(
        F.col("id").cast("string").alias("card_number"),
        (F.col("id") % 2).cast("byte").alias("label"),
    )
    return df.select(
        "card_number",
        "label",
        (F.col("label") * 10 + F.rand(5)).alias("avg_amount"),
        (F.col("label") * 3 + F.rand(6)).alias("unique_merchants"),
        F.rand(7).alias("noise"),
    )


def test_class_weights_balanced(spark):
    train = spark.createDataFrame([(1,), (0,), (0,), (0,)], "label int")
    w = {r.label: r.class_weight for r in M.class_weight_table(train).collect()}
    assert w == {0: 4 / (2 * 3), 1: 4 / (2 * 1)}


def test_standardize_population_std(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    out = M.standardize(df, df, ["a", "b"]).collect()
    assert sorted(r.a for r in out) == [-1.0, 1.0]
    assert [r.b for r in out] == [0.0, 0.0]  # zero std -> centred only


def test_train_score_select_and_reload(spark):
    cards = _cards(spark)
    train, test, cols = split_train_test(cards)
    models = M.train_models(train, cols)
    assert set(models) == {"logistic_regression", "random_forest"}
    from cardlens.operators.evaluate import roc_auc

    aucs = {k: roc_auc(M.score_cards(m, test)).first().roc_auc for k, m in models.items()}
    assert all(a > 0.9 for a in aucs.values())
    path = tempfile.mkdtemp(prefix="cardlens-model-")
    sinks.save_model(models["logistic_regression"], path + "/lr")
    again = sinks.load_model(path + "/lr")
    s1 = {r.card_number: r.y_proba for r in M.score_cards(models["logistic_regression"], test).collect()}
    s2 = {r.card_number: r.y_proba for r in M.score_cards(again, test).collect()}
    assert s1 == s2
    imp, kind = M.feature_importance(models["random_forest"], cols)
    assert kind == "feature_importance" and len(imp) == len(cols)
    imp, kind = M.feature_importance(models["logistic_regression"], cols)
    assert kind == "absolute_coefficient" and min(imp) >= 0


def test_mark_best_rules(spark):
    def best(*rows):
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "position int, model_name string, roc_auc double, f1 double")
        return M.mark_best(df).filter("is_best").first().model_name

    assert best(("a", 0.6, 0.9), ("b", 0.7, 0.1)) == "b"
    assert best(("a", None, 0.2), ("b", float("nan"), 0.5)) == "b"
    assert best(("a", 0.7, 0.0), ("b", 0.7, 1.0)) == "a"
    assert best(("a", None, None), ("b", None, 0.0)) == "b"


def test_medians_only_where_something_is_missing(spark):
    rows = [(1.0, 1.0, float("nan")), (5.0, None, None), (None, 9.0, None), (float("nan"), 3.0, None)]
    df = spark.createDataFrame([(*r, 7.0) for r in rows], "a double, b double, c double, d double")
    assert M.fit_medians(df, ["a", "b", "c", "d"]) == {"a": 3.0, "b": 3.0, "c": 0.0}
    filled = M.impute_stage(["a", "d"], {"a": 3.0}).transform(df)
    assert sorted(r["_imp_a"] for r in filled.collect()) == [1.0, 3.0, 3.0, 5.0]
    assert {r["_imp_d"] for r in filled.collect()} == {7.0}


def test_forest_shape_and_seed(spark):
    train, test, cols = split_train_test(_cards(spark, 200))
    one, two = (M.train_models(train, cols, names=("random_forest",))["random_forest"] for _ in range(2))
    forest = one.stages[-1]
    assert forest.getNumTrees == 300 and abs(sum(forest.featureImportances) - 1) < 1e-9
    a, b = ({r.card_number: r.y_proba for r in M.score_cards(m, test).collect()} for m in (one, two))
    assert a == b


def test_job_splits_every_class_by_its_exact_share(spark):
    from cardlens.operators.materialize import materialize
    from cardlens.plans.pipeline import train_and_compare

    cards = materialize(_cards(spark, 130).filter("label = 1 OR card_number % 4 = 0"), "cards")  # 65 and 33
    run = train_and_compare(spark, cards)
    sizes = {r.label: r["count"] for r in run["test"].groupBy("label").count().collect()}
    assert sizes == {1: 13, 0: 7}
    assert run["train"].count() + run["test"].count() == 98
    assert run["train"].join(run["test"], "card_number", "left_semi").isEmpty()
    assert {name: p.count() for name, p in run["predictions"].items()} == dict.fromkeys(run["models"], 20)


def test_missing_sources_listed_together(spark):
    d = tempfile.mkdtemp(prefix="cardlens-raw-")
    spark.range(1).write.parquet(os.path.join(d, "consumer_cards.parquet"))
    with pytest.raises(FileNotFoundError) as e:
        load_raw_data(spark, d)
    assert "business_cards.parquet" in str(e.value) and "merchants_reference.parquet" in str(e.value)
    assert "consumer_cards.parquet" not in str(e.value)


def test_end_to_end_pipeline(spark):
    from cardlens.plans.pipeline import run_pipeline
    from cardlens.sources.fixtures import event_sources

    raw_dir = tempfile.mkdtemp(prefix="cardlens-raw-")
    out_dir = tempfile.mkdtemp(prefix="cardlens-out-")
    for name, df in event_sources(spark, "/root/testdata/sf0.01").items():
        df.write.mode("overwrite").parquet(f"{raw_dir}/{name}.parquet")
    run = run_pipeline(spark, raw_dir, out_dir)
    assert run["best"] in ("logistic_regression", "random_forest")
    feats = spark.read.parquet(f"{out_dir}/processed/card_level_features.parquet")
    assert feats.count() == 150 and len(feats.columns) == 28
    preds = spark.read.option("header", True).csv(f"{out_dir}/predictions/test_predictions.csv")
    probs = [float(r.y_proba) for r in preds.collect()]
    assert probs == sorted(probs, reverse=True) and len(probs) > 0
    summary = spark.read.json(f"{out_dir}/metrics/metrics.json").first()
    assert summary.best_model == run["best"] and summary.feature_count == 26
    assert len(summary.top_features) == 15
    reports = {m.model_name: [c.class_name for c in m.classification_report] for m in summary.models}
    assert set(reports) == {"logistic_regression", "random_forest"}
    assert all(r == ["consumer", "business_like", "accuracy", "macro avg", "weighted avg"] for r in reports.values())


def test_pipeline_missing_sources_exit_code(spark, capsys):
    from cardlens.plans.pipeline import main

    d = tempfile.mkdtemp(prefix="cardlens-empty-")
    assert main(["pipeline.py", d, d + "/out"]) == 1
    assert "not found" in capsys.readouterr().err
