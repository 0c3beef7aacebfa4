"""Exploratory merchant-category queries and MCC target encoding.

All take a labelled transaction frame (``label`` 1=business, 0=consumer,
typed and cleaned). MCC weight tables have one row per MCC code, so they are
joined back through :func:`checked_broadcast` (measured, then broadcast).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.config import (
    CARD_ID_COLUMN,
    MCC_RESTAURANT,
    MCC_SUPERMARKET,
    MCC_TAXI,
    TARGET_COLUMN,
    TOP20_MCC,
)
from cardlens.operators.features import fill_numeric_nulls, nan_skipping_max
from cardlens.operators.joins import join_dimension
from cardlens.operators.materialize import materialize
from cardlens.operators.quantiles import group_quantile_nearest

AMOUNT = "transaction_amount_kzt"


def mcc_column(df: DataFrame) -> str:
    """The MCC column of a source: ``mcc`` if present, else ``mcc_code``."""
    return "mcc" if "mcc" in df.columns else "mcc_code"


def mcc_mix(txn: DataFrame, codes=TOP20_MCC, target: str = TARGET_COLUMN) -> DataFrame:
    """Per listed MCC: total, business and consumer counts, business share
    (sorted by share, descending; at most ``len(codes)`` rows)."""
    m = mcc_column(txn)
    t = txn.withColumn(m, F.col(m).cast("string"))
    return (
        t.filter(F.col(m).isin(*codes))
        .groupBy(m)
        .agg(
            F.count(F.lit(1)).alias("total_count"),
            F.sum(F.col(target).cast("long")).alias("business_count"),
            F.count_if(F.col(target) == 0).alias("consumer_count"),
        )
        .withColumn("business_share", F.col("business_count") / F.col("total_count"))
        .orderBy(F.desc("business_share"), F.asc(m))
    )


def mcc_weights(txn: DataFrame, target: str = TARGET_COLUMN) -> DataFrame:
    """Business rate per MCC (``mcc_b2b_weight``), null MCC included as a group.

    Leaky when applied back to the same transactions it was fitted on: each
    card's own label enters its weights. Use :func:`safe_features` to fit on
    training cards only.
    """
    m = mcc_column(txn)
    return (
        txn.withColumn(m, F.col(m).cast("string"))
        .groupBy(m)
        .agg(F.avg(F.col(target).cast("double")).alias("mcc_b2b_weight"))
    )


def attach_weights(txn: DataFrame, weights: DataFrame) -> DataFrame:
    """Left join of per-MCC weights (null MCC never matches)."""
    m = mcc_column(txn)
    return join_dimension(txn.withColumn(m, F.col(m).cast("string")), weights, on=m, how="left")


def _amount_if(code: str) -> Column:
    return F.when(F.col("mcc") == code, F.col(AMOUNT))


def household_aggregates() -> list[Column]:
    return [
        F.max(_amount_if(MCC_SUPERMARKET)).alias("max_amount_mcc_5411"),
        F.sum(_amount_if(MCC_SUPERMARKET)).alias("sum_amount_mcc_5411"),
        F.max(_amount_if(MCC_RESTAURANT)).alias("max_amount_mcc_5812"),
        F.sum(_amount_if(MCC_TAXI)).alias("sum_amount_mcc_4121"),
    ]


def with_q95(
    cards: DataFrame,
    txn: DataFrame,
    out: str = "global_quantile_95",
    keys: list[str] | None = None,
) -> DataFrame:
    """Left-join the per-card nearest-rank q95 of ``txn`` to ``cards``.

    ``keys`` (default: the card) identify a card row in both frames.
    """
    keys = keys or [CARD_ID_COLUMN]
    q = group_quantile_nearest(txn, keys, AMOUNT, 0.95, out)
    return cards.join(q, keys, "left")


def card_amount_q95(txn: DataFrame) -> DataFrame:
    return group_quantile_nearest(txn, CARD_ID_COLUMN, AMOUNT, 0.95, "global_quantile_95")


def card_b2b_index(weighted: DataFrame) -> DataFrame:
    return weighted.groupBy(CARD_ID_COLUMN).agg(
        F.max(TARGET_COLUMN).alias(TARGET_COLUMN),
        F.avg("mcc_b2b_weight").alias("card_b2b_index"),
    )


# columns the per-card MCC families read (the input is written once as parquet
# because each family reads it three times: weights, card pass and q95)
_MCC_INPUT = [CARD_ID_COLUMN, TARGET_COLUMN, AMOUNT, "mcc"]
_EXT_INPUT = _MCC_INPUT + ["transaction_timestamp", "channel", "Is_recurring"]


def b2b_index(txn: DataFrame) -> DataFrame:
    """:func:`card_b2b_index` with (leaky) weights of the same transactions, parsed once."""
    txn = materialize(txn.select(CARD_ID_COLUMN, TARGET_COLUMN, mcc_column(txn)), "mcc-input")
    return card_b2b_index(attach_weights(txn, mcc_weights(txn)))


def household_features(txn: DataFrame) -> DataFrame:
    """Amount profile + (leaky) B2B index + household-MCC amounts per card."""
    txn = materialize(txn.select(*_MCC_INPUT), "mcc-input")
    weighted = attach_weights(txn, mcc_weights(txn))
    cards = weighted.groupBy(CARD_ID_COLUMN).agg(
        F.max(TARGET_COLUMN).alias(TARGET_COLUMN),
        nan_skipping_max(F.col(AMOUNT)).alias("global_max_amount"),
        F.avg(AMOUNT).alias("global_mean_amount"),
        F.avg("mcc_b2b_weight").alias("card_b2b_index"),
        *household_aggregates(),
    )
    return fill_numeric_nulls(with_q95(cards, txn))


def _hour_share(hour: Column, lo: int, hi: int) -> Column:
    # null hour stays null and drops out of the mean
    return F.avg(hour.between(lo, hi).cast("double"))


def extended_aggregates(weight: Column) -> list[Column]:
    hour = F.hour("transaction_timestamp")
    return [
        F.max(TARGET_COLUMN).alias(TARGET_COLUMN),
        nan_skipping_max(F.col(AMOUNT)).alias("global_max_amount"),
        F.avg(weight).alias("card_b2b_index"),
        _hour_share(hour, 0, 5).alias("night_trans_share"),
        _hour_share(hour, 9, 18).alias("working_hours_share"),
        F.avg((F.col("channel") == "online").cast("double")).alias("online_share"),
        F.avg((F.col("Is_recurring") == F.lit(True)).cast("double")).alias("recurring_share"),
    ]


def extended_features(txn: DataFrame) -> DataFrame:
    """Money + time + channel features per card with the (leaky) B2B index."""
    txn = materialize(txn.select(*_EXT_INPUT), "mcc-input")
    weighted = attach_weights(txn, mcc_weights(txn))
    cards = weighted.groupBy(CARD_ID_COLUMN).agg(*extended_aggregates(F.col("mcc_b2b_weight")))
    return fill_numeric_nulls(with_q95(cards, txn))


SIDE = "is_test"


def build_safe_features(txn: DataFrame) -> DataFrame:
    """Train-fitted MCC weights applied to both sides (no label leakage).

    ``txn`` is labelled and carries ``is_test``; the result has one row per card and
    side. Before aggregating, a missing weight (MCC unseen in training, or null
    MCC) and a missing amount count as 0.0.

    Both sides go through one weight join, one card pass and one q95 pass, grouped
    by ``(card, side)``; the q95 pass needs no weights and reads the input alone.
    """
    both = txn.select(*_EXT_INPUT, F.col(SIDE).cast("boolean").alias(SIDE))
    both = materialize(both.withColumn(AMOUNT, F.coalesce(F.col(AMOUNT), F.lit(0.0))), "safe-input")
    weights = mcc_weights(both.filter(~F.col(SIDE)))
    weight = F.coalesce(F.col("mcc_b2b_weight"), F.lit(0.0))
    keys = [CARD_ID_COLUMN, SIDE]
    cards = attach_weights(both, weights).groupBy(*keys).agg(*extended_aggregates(weight))
    return fill_numeric_nulls(with_q95(cards, both, keys=keys))


def safe_features(train_txn: DataFrame, test_txn: DataFrame) -> tuple[DataFrame, DataFrame]:
    """:func:`build_safe_features` for two frames; a card present in both gets one
    row per frame. The card rows are written once, so both results read them."""
    both = train_txn.select(*_EXT_INPUT, F.lit(False).alias(SIDE)).unionByName(
        test_txn.select(*_EXT_INPUT, F.lit(True).alias(SIDE))
    )
    cards = materialize(build_safe_features(both), "safe-cards")
    return cards.filter(~F.col(SIDE)).drop(SIDE), cards.filter(F.col(SIDE)).drop(SIDE)


def class_profile(cards: DataFrame, columns: list[str], target: str = TARGET_COLUMN) -> DataFrame:
    """Mean of each feature per class (one row per label)."""
    return cards.groupBy(target).agg(*[F.avg(c).alias(f"mean_{c}") for c in columns])


def card_sanity_check(txn: DataFrame, n: int = 10) -> DataFrame:
    """Per-card MCC variety, row count, amount spread; first ``n`` cards.

    ``unique_mcc_count`` counts a null MCC as one more value, as the
    exploratory check did.
    """
    m = mcc_column(txn)
    cards = txn.groupBy(CARD_ID_COLUMN).agg(
        (F.count_distinct(m) + F.max(F.col(m).isNull().cast("long"))).alias("unique_mcc_count"),
        F.count(AMOUNT).alias("total_trans"),
        F.stddev_samp(AMOUNT).alias("amount_std"),
        F.avg(AMOUNT).alias("amount_mean"),
    )
    return cards.orderBy(CARD_ID_COLUMN).limit(n)
