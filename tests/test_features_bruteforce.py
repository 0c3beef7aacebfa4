"""All 26 card features vs an independent pandas computation, on a fixture
where one card holds a third of all rows."""

import math
import random

import numpy as np
import pandas as pd

from cardlens.operators.clean import normalize_transactions
from cardlens.operators.enrich import add_target, merge_merchants
from cardlens.operators.features import CARD_FEATURES, build_card_level_features


def _fixture(spark, n=3000, seed=17):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        card = "hot" if i % 3 == 0 else f"c{rnd.randint(0, 60)}"
        day = rnd.randint(1, 28)
        hour = rnd.randint(0, 23)
        rows.append(
            (
                card,
                float(rnd.choice([-500, 150, 1999.99, 2000, 7000, 49999, 50000, 120000])) + rnd.randint(0, 3),
                rnd.choice([None, *range(40)]),
                rnd.choice([None, "5411", "5812", "4121", "3000"]),
                rnd.choice([None, "online", "OFFLINE", "other"]),
                f"2024-02-{day:02d}" if rnd.random() > 0.1 else None,
                f"2024-02-{day:02d} {hour:02d}:15:00" if rnd.random() > 0.2 else None,
                rnd.choice([None, "KZ", "US", "DE"]),
                rnd.choice(["1", "0", "yes", None]),
                rnd.choice([True, False, None]),
            )
        )
    schema = (
        "card_number string, transaction_amount_kzt double, merchant_id int, mcc string, channel string, "
        "transaction_date string, transaction_timestamp string, country string, tokenized string, "
        "Is_recurring boolean"
    )
    mer = [(m, f"m{m}", rnd.choice(["KZ", "US", None]), m % 2) for m in range(0, 40, 2)]
    mer_df = spark.createDataFrame(mer, "merchant_id int, merchant_name string, merchant_country string, recurring_capable int")
    return spark.createDataFrame(rows, schema), mer_df


def _pandas_features(txn: pd.DataFrame) -> pd.DataFrame:
    t = txn.copy()
    amt = t["transaction_amount_kzt"]
    hour = pd.to_datetime(t["transaction_datetime"]).dt.hour
    dates = pd.to_datetime(t["transaction_date"])
    ind = pd.DataFrame(
        {
            "card_number": t["card_number"],
            "online_share": (t["channel"] == "online").astype(float),
            "offline_share": (t["channel"] == "offline").astype(float),
            "recurring_share": t["Is_recurring"].astype(float),
            "tokenized_share": t["tokenized"].astype(float),
            "recurring_capable_share": t["recurring_capable"].astype(float),
            "weekend_share": (dates.dt.weekday >= 5).fillna(False).astype(float),
            "night_share": hour.between(0, 5).astype(float),
            "morning_share": hour.between(6, 11).astype(float),
            "evening_share": hour.between(18, 23).astype(float),
            "small_txn_share": (amt.abs() < 2000).astype(float),
            "large_txn_share": (amt.abs() >= 50000).astype(float),
        }
    )
    g = t.groupby("card_number")
    out = pd.DataFrame(
        {
            "label": g["label"].max(),
            "total_transactions": g.size(),
            "total_amount": g["transaction_amount_kzt"].sum(),
            "avg_amount": g["transaction_amount_kzt"].mean(),
            "median_amount": g["transaction_amount_kzt"].median(),
            "max_amount": g["transaction_amount_kzt"].max(),
            "std_amount": g["transaction_amount_kzt"].std(ddof=1).fillna(0.0),
            "active_days": g["transaction_date"].nunique(),
            "unique_merchants": g["merchant_id"].nunique(),
            "unique_mcc": g["mcc"].nunique(),
            "unique_countries": g["country"].nunique(),
            "unique_merchant_countries": g["merchant_country"].nunique(),
        }
    ).join(ind.groupby("card_number").mean())
    out["transactions_per_active_day"] = np.where(out.active_days > 0, out.total_transactions / out.active_days.clip(lower=1), 0.0)
    out["merchant_diversity_ratio"] = out.unique_merchants / out.total_transactions
    out["mcc_diversity_ratio"] = out.unique_mcc / out.total_transactions
    out["amount_cv"] = np.where(out.avg_amount.abs() > 0, out.std_amount / out.avg_amount.abs().where(out.avg_amount != 0, 1), 0.0)
    return out


def test_features_match_pandas_with_hot_card(spark):
    raw, mer = _fixture(spark)
    txn = merge_merchants(add_target(normalize_transactions(raw), 0), mer)
    pdf = txn.toPandas()
    want = _pandas_features(pdf)
    got = build_card_level_features(txn).toPandas().set_index("card_number")
    assert set(got.index) == set(want.index)
    assert got.loc["hot", "total_transactions"] == 1000
    for c in CARD_FEATURES:
        for card in want.index:
            a, b = float(got.loc[card, c]), float(want.loc[card, c])
            assert math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9), (c, card, a, b)
