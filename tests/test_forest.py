"""Bootstrap samples, their class weights, and the forest of groups."""

import hashlib
import math
import threading

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cardlens.operators import forest, score_tables
from cardlens.operators.materialize import materialize, scratch_path

COLS = ["a", "b"]


def _hash(card, group, seed):
    return int(hashlib.md5(f"{card or ''}:{seed}:{group}".encode()).hexdigest()[:8], 16)


def _draws(card, group, seed):
    """Poisson quantile of the hash, by summing the distribution."""
    u, k, share = _hash(card, group, seed), 0, math.exp(-1)
    below = share
    while k < forest.MOST_DRAWS and u >= round(below * 2**32):
        k += 1
        share /= k
        below += share
    return k


@pytest.fixture(scope="module")
def cards(spark):
    df = spark.range(2000).select(
        F.col("id").cast("string").alias("card_number"), (F.col("id") % 5 == 0).cast("double").alias("label")
    )
    a = F.col("label") + F.pmod(F.xxhash64("card_number"), F.lit(1000)) / 700
    return df.withColumns({"a": a, "b": F.pmod(F.xxhash64("label", "card_number"), F.lit(97)).cast("double")})


@pytest.fixture(scope="module")
def matrix(cards):
    return materialize(VectorAssembler(inputCols=COLS, outputCol="features").transform(cards), "matrix")


def test_draws_are_poisson_and_equal_brute_force(spark, cards):
    rows = cards.select("card_number", forest.draws(F.col("card_number"), F.lit(3), 7).alias("n")).collect()
    assert all(r.n == _draws(r.card_number, 3, 7) for r in rows)
    n = len(rows)
    assert abs(sum(r.n for r in rows) / n - 1) < 0.1
    assert abs(sum(r.n == 0 for r in rows) / n - math.exp(-1)) < 0.04
    # a group has a sample of its own
    other = cards.select(forest.draws(F.col("card_number"), F.lit(4), 7).alias("n")).collect()
    assert sum(a.n != b.n for a, b in zip(rows, other, strict=True)) > n / 2


def test_weights_balance_every_sample(spark, cards):
    groups = 4
    want = {}
    for r in cards.collect():
        for g in range(groups):
            if k := _draws(r.card_number, g, 42):
                c, d = want.get((g, r.label), (0, 0))
                want[g, r.label] = (c + 1, d + k)
    for frame in (cards, cards.repartition(7), cards.orderBy(F.desc("card_number"))):
        got = forest.bootstrap_weights(frame, groups).collect()
        assert {(r.tree_group, r.label): (r.n_cards, r.n_draws) for r in got} == want
        for g in range(groups):
            mass = [r.class_weight * r.n_draws for r in got if r.tree_group == g]
            assert len(mass) == 2 and abs(mass[0] - mass[1]) < 1e-9
            assert abs(sum(mass) - sum(r.n_draws for r in got if r.tree_group == g)) < 1e-9


def test_null_cards_one_class_and_no_rows(spark):
    odd = spark.createDataFrame([(None, 1.0), ("", 1.0), (None, 1.0), ("x", 1.0)], "card_number string, label double")
    for r in forest.bootstrap_weights(odd, 30).collect():
        bare = 3 * _draws("", r.tree_group, 42)
        assert r.n_draws == bare + _draws("x", r.tree_group, 42) and r.class_weight == 1.0
    empty = odd.limit(0)
    assert forest.bootstrap_weights(empty, 5).collect() == []
    with pytest.raises(ValueError, match="no training rows"):
        forest.group_fits(empty.withColumn("features", F.lit(None)), 6, 3)


def test_forest_is_the_mean_of_its_trees(spark, cards, matrix):
    fits = forest.group_fits(matrix, 10, 4, minInstancesPerNode=3, maxDepth=6)
    parts = forest.concurrently(spark, fits)
    assert [p.getNumTrees for p in parts] == [3, 3, 2, 2]
    model = forest.one_forest(spark, parts)
    assert model.getNumTrees == 10 and model.numClasses == 2 and abs(sum(model.featureImportances) - 1) < 1e-9

    def scores(m):
        found = m.transform(matrix).select("card_number", vector_to_array("probability")[1].alias("p")).collect()
        return {r.card_number: r.p for r in found}

    each, got = [scores(p) for p in parts], scores(model)
    for card, p in got.items():
        assert abs(p - sum(s[card] * m.getNumTrees for s, m in zip(each, parts, strict=True)) / 10) < 1e-12
    path = scratch_path(spark, "forest")
    model.save(path)
    assert scores(RandomForestClassificationModel.load(path)) == got
    nodes = score_tables.forest_table(spark, path, COLS)
    by_table = score_tables.score_forest(cards, nodes, "card_number", COLS, score_tables.forest_depth(model))
    assert all(abs(r.y_proba - got[r.card_number]) < 1e-12 for r in by_table.collect())


def test_trees_are_trained_on_balanced_samples(spark, matrix):
    """The root of a tree holds the weighted draws of its group: both classes weigh the same."""
    parts = forest.concurrently(spark, forest.group_fits(matrix, 4, 2, maxDepth=2))
    path = scratch_path(spark, "forest")
    forest.one_forest(spark, parts).save(path)
    roots = spark.read.parquet(f"{path}/data").filter("nodeData.id = 0").select("treeID", "nodeData.impurityStats").collect()
    assert len(roots) == 4
    totals = {g: sum(_draws(r.card_number, g, 42) for r in matrix.collect()) for g in range(2)}
    for r in roots:
        zero, one = r.impurityStats
        assert abs(zero - one) < 1e-6 and round(zero + one) in totals.values()


def test_histograms_do_not_multiply_with_the_partitions_of_the_matrix(spark, matrix, monkeypatch):
    files = matrix.repartition(8)
    assert forest.packed(files).rdd.getNumPartitions() == 1
    few = forest.packed(files, 900)  # bounded, and every row once
    assert few.rdd.getNumPartitions() == 3
    assert sorted(r.card_number for r in few.collect()) == sorted(r.card_number for r in matrix.collect())
    seen = []

    def fit(self, sample):
        seen.append(sample.rdd.getNumPartitions())

    monkeypatch.setattr(forest.RandomForestClassifier, "fit", fit)
    for job in forest.group_fits(files, 4, 2):
        job()
    assert seen == [1, 1]


def test_tasks_run_side_by_side_in_order_and_fail_loudly(spark):
    meet = threading.Barrier(2, timeout=60)

    def job(n):
        meet.wait()  # passes only if two tasks run at once
        return spark.range(n).count()

    assert forest.concurrently(spark, [lambda n=n: job(n) for n in (5, 3, 8, 1)], threads=2) == [5, 3, 8, 1]
    with pytest.raises(ZeroDivisionError):
        forest.concurrently(spark, [lambda: 1 // 0, lambda: spark.range(3).count()], threads=2)


def test_plan_bounds_the_nodes_in_the_driver():
    assert forest.fit_plan(1200, 300, 10, 3) == (None, forest.FIT_THREADS)  # as one model
    assert forest.fit_plan(0, 300, 10, 3) == forest.fit_plan(10**9, 300, 10, 3, depth=2) == (None, forest.FIT_THREADS)
    for cards in (7_500, 72_000, 432_000):
        trees, threads = forest.fit_plan(cards, 300, 10, 3)
        assert 1 <= trees <= 30 and 1 <= threads <= forest.RF_PART_THREADS
        assert trees * threads * 2 * cards * 0.632 / 3 <= forest.RF_DRIVER_NODES
    assert forest.fit_plan(2_000_000, 300, 10, 3) == (1, 1)  # one tree is not divided, whatever its size


def test_saved_parts_score_like_one_forest(spark, cards, matrix):
    """Also for cards that repeat or are null, and after saving."""
    parts = forest.concurrently(spark, forest.group_fits(matrix, 7, 2, most_trees=3, minInstancesPerNode=3, maxDepth=6))
    assert [p.getNumTrees for p in parts] == [3, 1, 3]
    one = forest.one_forest(spark, parts)
    of_parts = forest.ForestParts([forest.save_part(spark, lambda p=p: p) for p in parts], threads=2)
    assert of_parts.getNumTrees == 7
    assert all(abs(x - y) < 1e-12 for x, y in zip(of_parts.featureImportances, one.featureImportances.toArray(), strict=True))
    odd = matrix.union(matrix.limit(5)).union(matrix.limit(3).withColumn("card_number", F.lit(None).cast("string")))

    def scores(model):
        found = model.transform(odd).select(
            "card_number", "features", vector_to_array("rawPrediction"), vector_to_array("probability"), "prediction"
        )
        return sorted((str(r[0]), *r.features, *r[2], *r[3], r.prediction) for r in found.collect())

    want, got = scores(one), scores(of_parts)
    assert len(got) == 2008 and scores(of_parts) == got
    for a, b in zip(want, got, strict=True):
        assert a[:3] == b[:3] and all(abs(x - y) < 1e-12 for x, y in zip(a[3:], b[3:], strict=True))
    path = scratch_path(spark, "parts")
    PipelineModel([of_parts]).write().overwrite().save(path)
    assert scores(PipelineModel.load(path)) == got
    assert of_parts.transform(matrix.limit(0)).count() == 0


def test_no_fit_and_no_model_holds_a_large_forest(spark, cards, monkeypatch):
    """The whole forest of cards that all differ must not be in the driver: fits of few trees, kept on disk."""
    from cardlens.operators import model as M

    monkeypatch.setattr(M, "RF_NUM_TREES", 8)
    monkeypatch.setattr(M, "RF_GROUPS", 2)
    monkeypatch.setattr(forest, "RF_DRIVER_NODES", 3400)  # four trees of 2,000 cards
    monkeypatch.setattr(forest, "RF_PART_THREADS", 2)
    running, most, one = [], [], threading.Lock()
    fit = forest.RandomForestClassifier.fit

    def watched(self, sample):
        with one:
            running.append(self.getNumTrees())
            most.append(sum(running))
        try:
            return fit(self, sample)
        finally:
            with one:
                running.remove(self.getNumTrees())

    monkeypatch.setattr(forest.RandomForestClassifier, "fit", watched)
    model = M.train_models(cards, COLS, names=("random_forest",))["random_forest"]
    parts = model.stages[-1]
    assert isinstance(parts, forest.ForestParts) and parts.getNumTrees == 8
    assert len(parts.parts) == 4 and max(most) <= 4
    values, kind = M.feature_importance(model, COLS)
    assert kind == "feature_importance" and abs(sum(values) - 1) < 1e-9
    scored = M.score_cards(model, cards).collect()
    assert sorted(r.card_number for r in scored) == sorted(r.card_number for r in cards.collect())
    assert sum((r.y_proba > 0.5) == r.y_true for r in scored) > 1800
