import itertools
import random

from pyspark.sql import functions as F

from cardlens.operators import evaluate
from cardlens.operators.split import assign_split


def _scored(spark, rows):
    return spark.createDataFrame(rows, "card_number string, y_true int, y_proba double")


def _brute_auc(rows):
    pos = [p for _, y, p in rows if y == 1]
    neg = [p for _, y, p in rows if y == 0]
    wins = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg))
    return wins / (len(pos) * len(neg))


def test_auc_with_ties_matches_brute_force(spark):
    rnd = random.Random(1)
    rows = [(str(i), rnd.randint(0, 1), round(rnd.random(), 1)) for i in range(300)]
    got = evaluate.roc_auc(_scored(spark, rows)).first().roc_auc
    assert abs(got - _brute_auc(rows)) < 1e-12


def test_auc_symmetry_and_single_class(spark):
    rows = [("a", 1, 0.9), ("b", 0, 0.1), ("c", 1, 0.4), ("d", 0, 0.4)]
    auc = evaluate.roc_auc(_scored(spark, rows)).first().roc_auc
    neg = evaluate.roc_auc(_scored(spark, [(c, y, -p) for c, y, p in rows])).first().roc_auc
    assert abs(auc + neg - 1.0) < 1e-12 and auc == 0.875
    assert evaluate.roc_auc(_scored(spark, [("a", 1, 0.3), ("b", 1, 0.2)])).first().roc_auc is None


def test_metrics_zero_division_and_confusion(spark):
    pred = evaluate.predict_with_threshold(_scored(spark, [("a", 1, 0.2), ("b", 0, 0.1)]))
    m = evaluate.binary_metrics(pred).first()
    assert (m.precision, m.recall, m.f1, m.accuracy) == (0.0, 0.0, 0.0, 0.5)
    cm = {(r.y_true, r.y_pred): r.n for r in evaluate.confusion_matrix(pred).collect()}
    assert cm == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 0}
    rep = {r.class_name: r for r in evaluate.classification_report(pred).collect()}
    assert rep["consumer"].recall == 1.0 and rep["business_like"].support == 1
    assert rep["accuracy"].f1_score == 0.5 and rep["macro avg"].precision == 0.25


def test_threshold_is_inclusive(spark):
    pred = evaluate.predict_with_threshold(_scored(spark, [("a", 1, 0.5), ("b", 0, 0.4999)]))
    assert {r.card_number: r.y_pred for r in pred.collect()} == {"a": 1, "b": 0}


def test_split_disjoint_complete_stable(spark):
    cards = spark.range(5000).select(F.col("id").cast("string").alias("card_number"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    a = {r.card_number: r.is_test for r in assign_split(cards).collect()}
    b = {r.card_number: r.is_test for r in assign_split(cards.repartition(11)).collect()}
    assert a == b and len(a) == 5000
    share = sum(a.values()) / len(a)
    assert 0.17 < share < 0.23
    for lab in (0, 1):
        ids = [c for c in a if (int(c) % 3 == 0) == bool(lab)]
        s = sum(a[c] for c in ids) / len(ids)
        assert 0.16 < s < 0.24


def test_exact_stratified_split(spark):
    from cardlens.operators.split import assign_split_exact

    cards = spark.range(2003).select(
        F.col("id").cast("string").alias("card_number"), (F.col("id") % 7 == 0).cast("int").alias("label")
    )
    out = assign_split_exact(cards)
    rows = out.collect()
    assert len(rows) == 2003 and len({r.card_number for r in rows}) == 2003
    for lab in (0, 1):
        n = sum(1 for r in rows if r.label == lab)
        t = sum(1 for r in rows if r.label == lab and r.is_test)
        assert t == round(0.2 * n)
    again = {r.card_number: r.is_test for r in assign_split_exact(cards.repartition(5)).collect()}
    assert again == {r.card_number: r.is_test for r in rows}
