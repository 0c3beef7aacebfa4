import pytest
from pyspark.sql import functions as F

from cardlens.operators.clean import ensure_columns, normalize_merchants, normalize_transactions, require_columns
from cardlens.operators.enrich import combine_transactions, dedup_keep_first, merge_merchants


def _txn(spark, rows):
    return spark.createDataFrame(
        rows,
        "card_number long, transaction_amount_kzt string, merchant_id long, channel string, "
        "transaction_date string",
    )


def test_require_columns_lists_all_missing(spark):
    df = spark.createDataFrame([(1,)], "card_number long")
    with pytest.raises(ValueError, match="merchant_id, transaction_amount_kzt"):
        require_columns(df, ["card_number", "transaction_amount_kzt", "merchant_id"], "business_cards")


def test_defaults_are_typed(spark):
    df = ensure_columns(spark.createDataFrame([(1,)], "a int"), {"tokenized": False, "mcc": None})
    assert dict(df.dtypes) == {"a": "int", "tokenized": "boolean", "mcc": "string"}


def test_normalize_drops_rows_without_card_or_amount(spark):
    rows = [(1, "10", 5, "ONLINE", "2024-01-06"), (None, "10", 5, None, None),
            (2, "1.5d", 5, None, None), (3, None, None, "Offline", "bad")]
    out = normalize_transactions(_txn(spark, rows)).orderBy("card_number").collect()
    assert [r.card_number for r in out] == ["1"]
    r = out[0]
    assert r.channel == "online" and r.merchant_id == "5" and r.tokenized is False
    assert r.transaction_datetime is not None and r.transaction_timestamp is None


def test_channel_default_unknown(spark):
    out = normalize_transactions(_txn(spark, [(1, "1", 1, None, None)])).first()
    assert out.channel == "unknown"


def test_merchant_dedup_keeps_first_in_declared_order(spark):
    mer = spark.createDataFrame(
        [(1, "b-name", "KZ", "1", "5411"), (1, "a-name", None, "0", None), (2, None, "US", "yes", None)],
        "merchant_id long, merchant_name string, merchant_country string, recurring_capable string, mcc string",
    )
    out = {r.merchant_id: r for r in normalize_merchants(mer).collect()}
    assert set(out) == {"1", "2"}
    assert out["1"].merchant_name == "a-name" and out["1"].recurring_capable is False
    assert out["2"].recurring_capable is True
    assert "merchant_reference_mcc" in normalize_merchants(mer).columns


def test_dedup_nulls_last(spark):
    df = spark.createDataFrame([("k", None), ("k", "z")], "key string, v string")
    assert dedup_keep_first(df, "key").first().v == "z"


def test_join_defaults_and_row_count(spark):
    txn = normalize_transactions(_txn(spark, [(1, "1", 1, None, None), (1, "2", 9, None, None), (2, "3", None, None, None)]))
    mer = spark.createDataFrame([(1, "m1", "KZ", True)], "merchant_id long, merchant_name string, merchant_country string, recurring_capable boolean")
    out = merge_merchants(txn, mer)
    rows = {(r.card_number, r.transaction_amount_kzt): r for r in out.collect()}
    assert out.count() == 3
    assert rows[("1", 1.0)].merchant_country == "KZ" and rows[("1", 1.0)].recurring_capable is True
    assert rows[("1", 2.0)].merchant_country == "unknown" and rows[("1", 2.0)].recurring_capable is False
    assert rows[("2", 3.0)].merchant_country == "unknown"


def test_union_labels_and_mismatched_columns(spark):
    b = _txn(spark, [(1, "1", 1, None, None)])
    c = _txn(spark, [(2, "2", 1, None, None)])
    out = {r.card_number: r.label for r in combine_transactions(b, c).collect()}
    assert out == {"1": 1, "2": 0}
    with pytest.raises(Exception):
        combine_transactions(b.withColumn("extra", F.lit(1)), c).collect()


def test_concat_strict_and_shape(spark):
    from cardlens.operators.enrich import concat_strict, frame_shape

    a = spark.createDataFrame([(1, "x")], "id long, s string")
    b = spark.createDataFrame([(2, "y")], "id long, s string")
    assert frame_shape(concat_strict(a, b)) == (2, 2)
    with pytest.raises(ValueError, match="does not match"):
        concat_strict(a, spark.createDataFrame([(2, 1.0)], "id long, s double"))
    with pytest.raises(ValueError):
        concat_strict(a, spark.createDataFrame([("y", 2)], "s string, id long"))


def test_safe_features_one_row_per_card_and_side(spark):
    from cardlens.operators.mcc import safe_features

    schema = (
        "card_number string, label byte, transaction_amount_kzt double, mcc string, "
        "transaction_timestamp timestamp_ntz, channel string, Is_recurring boolean"
    )
    ts = __import__("datetime").datetime(2024, 1, 6, 10, 0)
    train = spark.createDataFrame(
        [("a", 1, 10.0, "5411", ts, "online", True), ("b", 0, 20.0, "5411", ts, "offline", False),
         ("b", 0, None, "5812", ts, "online", None)],
        schema,
    )
    # card "a" also appears in the test frame; mcc 4121 is unseen in training
    test = spark.createDataFrame(
        [("a", 1, 30.0, "4121", ts, "online", False), ("c", 0, 5.0, "5812", ts, "offline", True)], schema
    )
    tr, te = safe_features(train, test)
    tr = {r.card_number: r for r in tr.collect()}
    te = {r.card_number: r for r in te.collect()}
    assert set(tr) == {"a", "b"} and set(te) == {"a", "c"}
    # train weights: 5411 -> 0.5, 5812 -> 0.0; unseen and null weights count 0.0
    assert tr["a"].card_b2b_index == 0.5 and tr["b"].card_b2b_index == 0.25
    assert te["a"].card_b2b_index == 0.0 and te["c"].card_b2b_index == 0.0
    # a missing amount counts 0.0 before the max/q95
    assert tr["b"].global_max_amount == 20.0 and te["a"].global_quantile_95 == 30.0
