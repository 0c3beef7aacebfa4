import math

from pyspark.sql import functions as F

from cardlens.operators.clean import normalize_transactions
from cardlens.operators.enrich import combine_transactions, merge_merchants
from cardlens.operators.features import CARD_FEATURES, build_card_level_features

ROWS = [
    # card, amount, merchant, mcc, channel, date, timestamp, country
    ("solo", "100", 1, 5411, "online", "2024-01-06", "2024-01-06 03:00:00", "KZ"),
    ("zero", "50", 1, 5411, "offline", "2024-01-08", "2024-01-08 07:00:00", "KZ"),
    ("zero", "-50", 2, 5812, "offline", "2024-01-08", "2024-01-08 19:00:00", None),
    ("ts_only", "60000", 1, None, "ONLINE", None, "2024-01-06 12:00:00", "US"),
    ("both", "10", 1, 4121, None, "2024-01-07", None, "KZ"),
]


def _raw(spark, rows):
    return spark.createDataFrame(
        rows,
        "card_number string, transaction_amount_kzt string, merchant_id long, mcc int, channel string, "
        "transaction_date string, transaction_timestamp string, country string",
    )


def _features(spark, business_rows, consumer_rows):
    mer = spark.createDataFrame([(1, "m1", "KZ", 1)], "merchant_id long, merchant_name string, merchant_country string, recurring_capable int")
    txn = merge_merchants(combine_transactions(_raw(spark, business_rows), _raw(spark, consumer_rows)), mer)
    return {r.card_number: r for r in build_card_level_features(txn).collect()}, txn


def test_edge_cards(spark):
    feats, _ = _features(spark, [ROWS[4]], ROWS)
    solo, zero, ts_only, both = feats["solo"], feats["zero"], feats["ts_only"], feats["both"]
    assert solo.std_amount == 0.0 and solo.amount_cv == 0.0 and solo.night_share == 1.0
    assert zero.avg_amount == 0.0 and zero.amount_cv == 0.0 and zero.total_amount == 0.0
    assert zero.small_txn_share == 1.0 and zero.unique_merchant_countries == 2  # KZ + unknown
    assert zero.unique_countries == 1 and zero.evening_share == 0.5 and zero.morning_share == 0.5
    assert ts_only.active_days == 0 and ts_only.transactions_per_active_day == 0.0
    assert ts_only.weekend_share == 0.0 and ts_only.large_txn_share == 1.0 and ts_only.online_share == 1.0
    assert ts_only.unique_mcc == 0 and ts_only.mcc_diversity_ratio == 0.0
    assert both.label == 1 and both.total_transactions == 2  # card in both segments
    assert both.weekend_share == 1.0  # 2024-01-07 is a Sunday
    assert both.night_share == 1.0  # date-only -> midnight
    assert feats["solo"].label == 0


def test_no_nulls_and_properties(spark):
    feats, txn = _features(spark, [ROWS[4]], ROWS)
    total = 0
    for r in feats.values():
        d = r.asDict()
        assert all(d[c] is not None for c in CARD_FEATURES)
        for c in CARD_FEATURES:
            if c.endswith("_share"):
                assert 0.0 <= d[c] <= 1.0
        assert d["online_share"] + d["offline_share"] <= 1.0 + 1e-12
        assert d["night_share"] + d["morning_share"] + d["evening_share"] <= 1.0 + 1e-12
        assert d["unique_merchants"] <= d["total_transactions"]
        total += d["total_transactions"]
    assert total == txn.count()


def test_nan_amount_is_skipped_by_max(spark):
    rows = [("c", "NaN", 1, 1, None, None, None, None), ("c", "5", 1, 1, None, None, None, None)]
    feats, _ = _features(spark, [rows[1]], [rows[0]])
    assert feats["c"].max_amount == 5.0
    assert math.isnan(feats["c"].avg_amount)


def test_invariant_under_repartition(spark):
    _, txn = _features(spark, [ROWS[4]], ROWS)
    a = sorted(tuple(r) for r in build_card_level_features(txn).collect())
    b = sorted(tuple(r) for r in build_card_level_features(txn.repartition(7, F.rand(3))).collect())
    assert len(a) == len(b)
    for ra, rb in zip(a, b):
        for x, y in zip(ra, rb):
            if isinstance(x, float):
                assert math.isclose(x, y, rel_tol=1e-12, abs_tol=1e-12) or (math.isnan(x) and math.isnan(y))
            else:
                assert x == y


def test_median_of_small_cards(spark):
    _, txn = _features(spark, [ROWS[4]], ROWS)
    a = {r.card_number: r.median_amount for r in build_card_level_features(txn).collect()}
    assert a["zero"] == 0.0 and a["both"] == 10.0 and a["solo"] == 100.0
