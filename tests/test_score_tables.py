"""Scores from tables equal the scores of the fitted models."""

import random

import pytest
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array

from cardlens.operators import score_tables
from cardlens.operators.materialize import scratch_path

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def cards(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(400):
        a, b, c = rnd.gauss(0, 1), float(rnd.randint(0, 5)), rnd.uniform(0, 1e5)
        rows.append((f"k{i}", float(a + b * 0.3 + rnd.gauss(0, 1) > 0.7), a, b, c))
    df = spark.createDataFrame(rows, "card_number string, label double, a double, b double, c double")
    return df.repartition(4)


def _wanted(model, data):
    scored = model.transform(data).select("card_number", vector_to_array("probability")[1].alias("p"))
    return {r.card_number: r.p for r in scored.collect()}


def _close(got, want):
    got = {r.card_number: r.y_proba for r in got.collect()}
    assert got.keys() == want.keys()
    assert max(abs(got[k] - want[k]) for k in want) < 1e-12


def test_linear_table_equals_fitted_model(spark, cards):
    data = VectorAssembler(inputCols=COLS, outputCol="features").transform(cards)
    model = LogisticRegression(regParam=0.01).fit(data)
    table = score_tables.linear_table(spark, model, COLS)
    _close(score_tables.score_linear(cards, table, COLS).select("card_number", "y_proba"), _wanted(model, data))


@pytest.mark.parametrize("broadcast", ["10MB", "1"])
def test_forest_table_equals_saved_model(spark, cards, broadcast):
    """Node tables that are broadcast and node tables that are not give the same scores."""
    data = VectorAssembler(inputCols=COLS, outputCol="features").transform(cards)
    model = RandomForestClassifier(numTrees=7, maxDepth=5, minInstancesPerNode=3, seed=3).fit(data)
    path = scratch_path(spark, "forest")
    model.save(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        nodes = score_tables.forest_table(spark, path, COLS)
        assert nodes.filter("node = 0").count() == 7
        got = score_tables.score_forest(cards, nodes, "card_number", COLS, score_tables.forest_depth(model))
        _close(got, _wanted(model, data))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_missing_values_and_faulty_tables(spark):
    cards = spark.createDataFrame(
        [("low", 1.0), ("equal", 2.0), ("high", 3.0), ("nan", float("nan")), ("null", None)], "card_number string, a double"
    )
    rows = [(0, 0, "a", 2.0, 1, 2, None), (0, 1, None, None, None, None, 0.0), (0, 2, None, None, None, None, 1.0)]
    nodes = spark.createDataFrame(rows, score_tables.NODE_SCHEMA)
    got = {r.card_number: r.y_proba for r in score_tables.score_forest(cards, nodes, "card_number", ["a"], 1).collect()}
    assert got == {"low": 0.0, "equal": 0.0, "high": 1.0, "nan": 1.0, "null": 1.0}
    # a deeper limit changes nothing, a smaller one is an error
    assert score_tables.score_forest(cards, nodes, "card_number", ["a"], 4).filter("y_proba = 1").count() == 3
    with pytest.raises(Exception, match="no leaf reached"):
        score_tables.score_forest(cards, nodes, "card_number", ["a"], 0).collect()
    with pytest.raises(Exception, match="unknown feature"):
        score_tables.score_forest(cards.withColumnRenamed("a", "z"), nodes, "card_number", ["z"], 1).collect()
    line = spark.createDataFrame([("a", 1.0), (None, 0.0)], score_tables.LINEAR_SCHEMA)
    with pytest.raises(Exception, match="unknown features a"):
        score_tables.score_linear(cards.withColumnRenamed("a", "z"), line, ["z"]).collect()
    assert score_tables.score_linear(cards, line, ["a"]).filter("card_number = 'null'").collect()[0].y_proba is None
    # a feature that the table lacks counts nothing, even if it is null
    extra = cards.selectExpr("*", "CAST(NULL AS DOUBLE) AS z")
    assert score_tables.score_linear(extra, line, ["a", "z"]).filter("card_number = 'low'").collect()[0].y_proba > 0.5
    assert score_tables.score_forest(cards.limit(0), nodes, "card_number", ["a"], 1).collect() == []


@pytest.mark.parametrize("broadcast", ["10MB", "1"])
def test_importance_on_training_rows_equals_the_model(spark, cards, broadcast):
    """The rows of the model's own samples, by the draws that trained each group: the same importances."""
    from pyspark.sql import functions as F

    from cardlens.operators import forest

    data = VectorAssembler(inputCols=COLS, outputCol="features").transform(cards)
    model = forest.one_forest(spark, forest.concurrently(spark, forest.group_fits(data, 6, 1, maxDepth=5)))
    path = scratch_path(spark, "forest")
    model.save(path)
    weight = {r.label: r.class_weight for r in forest.bootstrap_weights(cards, 1).collect()}
    each = F.when(F.col("label") == 1, weight[1.0]).otherwise(weight[0.0])
    weighted = cards.withColumn("w", forest.draws(F.col("card_number"), F.lit(0)) * each)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        nodes = score_tables.forest_table(spark, path, COLS)
        found = score_tables.forest_importance(weighted, nodes, "label", COLS, score_tables.forest_depth(model), "w")
        got = {r.feature: r.importance for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got.keys() == set(COLS) and abs(sum(got.values()) - 1) < 1e-9
    assert all(abs(got[c] - x) < 1e-9 for c, x in zip(COLS, model.featureImportances.toArray(), strict=True))


def test_importance_of_nothing(spark, cards):
    leaf = spark.createDataFrame([(0, 0, None, None, None, None, 0.5)], score_tables.NODE_SCHEMA)
    rows = [(0, 0, "a", 0.0, 1, 2, None), (0, 1, None, None, None, None, 0.0), (0, 2, None, None, None, None, 1.0)]
    split = spark.createDataFrame(rows, score_tables.NODE_SCHEMA)

    def found(df, nodes):
        return {r.feature: r.importance for r in score_tables.forest_importance(df, nodes, "label", COLS, 2).collect()}

    nothing = dict.fromkeys(COLS, 0.0)
    assert found(cards, leaf) == found(cards.limit(0), split) == nothing
    assert found(cards.filter("label = 1"), split) == nothing  # one class: nothing to separate
    assert found(cards.selectExpr("* EXCEPT (label)", "CAST(NULL AS DOUBLE) AS label"), split) == nothing
    assert found(cards, split) == {"a": 1.0, "b": 0.0, "c": 0.0}
