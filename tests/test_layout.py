"""Features from the bucketed layout: the same rows, and no exchange."""

import pytest
from pyspark.sql import functions as F

from cardlens.config import FEATURE_REQUIRED_COLUMNS
from cardlens.operators import features, layout
from cardlens.operators.materialize import materialize, scratch_path
from cardlens.plans.queries import prepared

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def txn(spark):
    return materialize(prepared(spark, SF).select(*FEATURE_REQUIRED_COLUMNS), "txn")


def _rows(df):
    got = [[round(v, 6) if isinstance(v, float) else v for v in r] for r in df.collect()]
    return sorted(got, key=lambda r: str(r[0]))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _files(df) -> int:
    return df.select(F.input_file_name()).distinct().count()


def test_no_exchange_above_the_scan(spark, txn):
    made = layout.write_layout(txn, scratch_path(spark, "layout"), buckets=4)
    assert made.large.isEmpty() and made.buckets == 4 and _files(made.ordinary) <= 4
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables beyond broadcast
    try:
        got = layout.layout_features(made)
        assert "Exchange" not in _plan(got) and "SortMergeJoin" in _plan(got)
        plain = features.build_card_level_features(txn, materialize_input=False)
        assert "Exchange hashpartitioning(card_number" in _plan(plain)
        assert _rows(got) == _rows(plain)
        # any other grouping by card finds its rows in place, too
        other = made.ordinary.groupBy("card_number", "mcc").agg(F.sum("transaction_amount_kzt"))
        assert "Exchange" not in _plan(other)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("large_rows", [0, 70])
def test_large_cards_go_beside_the_buckets(spark, txn, large_rows):
    path = scratch_path(spark, "layout")
    made = layout.write_layout(txn, path, large_rows=large_rows, buckets=3)
    sizes = {r.card_number: r["count"] for r in txn.groupBy("card_number").count().collect()}
    large = {c for c, n in sizes.items() if n > large_rows}
    assert {r.card_number for r in made.large.select("card_number").distinct().collect()} == large and large
    assert {r.card_number for r in made.ordinary.select("card_number").distinct().collect()} == sizes.keys() - large
    assert _rows(layout.layout_features(layout.open_layout(spark, path))) == _rows(features.build_card_level_features(txn))


def test_hot_card_does_not_fill_a_bucket(spark, txn):
    """One card with over half of all rows: no bucket holds more than its share of the others."""
    hot = txn.filter("card_number IS NOT NULL").limit(1).select("card_number").first()[0]
    many = txn.unionByName(
        txn.withColumn("card_number", F.lit(hot)).withColumn("_x", F.explode(F.sequence(F.lit(1), F.lit(2)))).drop("_x")
    )
    most = txn.groupBy("card_number").count().agg(F.max("count")).first()[0]
    made = layout.write_layout(many, scratch_path(spark, "layout"), large_rows=most, buckets=4)
    sizes = made.ordinary.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert made.large.count() > many.count() / 2 and sizes < txn.count()
    assert _rows(layout.layout_features(made)) == _rows(features.build_card_level_features(many))


def test_reopened_layout_keeps_its_buckets(spark, txn):
    path = scratch_path(spark, "layout")
    made = layout.write_layout(txn, path)
    again = layout.open_layout(spark, path + "/")
    assert again.buckets == made.buckets >= 1
    assert "Exchange" not in _plan(again.ordinary.groupBy("card_number").count())
    assert sorted(map(str, again.ordinary.collect())) == sorted(map(str, txn.collect()))
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS|PATH_ALREADY"):
        layout.write_layout(txn, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        layout.open_layout(spark, scratch_path(spark, "nothing"))


def test_empty_rows_null_cards_and_missing_columns(spark, txn):
    none = layout.write_layout(txn.limit(0), scratch_path(spark, "layout"))
    assert layout.layout_features(none).collect() == [] and len(layout.layout_features(none).columns) == 28
    some = txn.withColumn("card_number", F.when(F.col("mcc") > "5000", F.col("card_number")))
    for rows in (10**6, 5):
        made = layout.write_layout(some, scratch_path(spark, "layout"), large_rows=rows, buckets=2)
        assert _rows(layout.layout_features(made)) == _rows(features.build_card_level_features(some))
    with pytest.raises(Exception, match="mcc"):
        layout.write_layout(txn.drop("mcc"), scratch_path(spark, "layout"))


def test_buckets_follow_the_rows():
    assert layout.bucket_count(0, 1) == 1 and layout.bucket_count(10, 8) == 8
    assert layout.bucket_count(2_000_001, 1) == 2 and layout.bucket_count(10**12, 8) == layout.MOST_BUCKETS
