"""Card-level behaviour features: one row per card from any volume of rows.

No task ever holds more than a bounded part of a card, no row reaches the driver:

* wide pass — one ``groupBy(card_number)`` of algebraic aggregates only
  (count, sum, avg, max, stddev, boolean shares): plain hash aggregation with
  a map-side partial, so a card holding a third of all rows shuffles one
  partial row per task;
* narrow pass — the five exact distinct counts over only the six columns they
  need: one set per column for cards of a bounded number of rows, distinct
  ``(card, column, value)`` rows for larger ones, which spreads a hot card over tasks;
* median pass — a bounded window for ordinary cards, narrowing by counts for large
  ones (:mod:`cardlens.operators.selection`);
* the card-level results are joined on the card (sizes ~ #cards); the two
  aggregates are already hash-partitioned on it, so joining them adds no exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.config import (
    CARD_ID_COLUMN,
    FEATURE_REQUIRED_COLUMNS,
    LARGE_TRANSACTION_AMOUNT,
    SMALL_TRANSACTION_AMOUNT,
    TARGET_COLUMN,
)
from cardlens.functions.parsing import guarded_ratio, iso_weekday
from cardlens.operators.clean import require_columns
from cardlens.operators.joins import checked_broadcast
from cardlens.operators.materialize import materialize
from cardlens.operators.quantiles import group_median_exact
from cardlens.operators.selection import WINDOW_ROWS

AMOUNT = "transaction_amount_kzt"

# indicator column -> share feature
SHARE_FEATURES = {
    "_is_online": "online_share",
    "_is_offline": "offline_share",
    "_is_recurring": "recurring_share",
    "_is_tokenized": "tokenized_share",
    "_is_recurring_capable": "recurring_capable_share",
    "_is_weekend": "weekend_share",
    "_is_night": "night_share",
    "_is_morning": "morning_share",
    "_is_evening": "evening_share",
    "_is_small_txn": "small_txn_share",
    "_is_large_txn": "large_txn_share",
}

ACTIVITY_FEATURES = [
    "total_transactions",
    "total_amount",
    "avg_amount",
    "median_amount",
    "max_amount",
    "std_amount",
    "active_days",
]
DIVERSITY_FEATURES = [
    "unique_merchants",
    "unique_mcc",
    "unique_countries",
    "unique_merchant_countries",
]
CHANNEL_SHARES = [
    "online_share",
    "offline_share",
    "recurring_share",
    "tokenized_share",
    "recurring_capable_share",
]
TIME_SHARES = ["weekend_share", "night_share", "morning_share", "evening_share"]
AMOUNT_SHARES = ["small_txn_share", "large_txn_share"]
RATIO_FEATURES = [
    "transactions_per_active_day",
    "merchant_diversity_ratio",
    "mcc_diversity_ratio",
    "amount_cv",
]
CARD_FEATURES = (
    ACTIVITY_FEATURES
    + DIVERSITY_FEATURES
    + CHANNEL_SHARES
    + TIME_SHARES
    + AMOUNT_SHARES
    + RATIO_FEATURES
)
INDICATOR_COLUMNS = list(SHARE_FEATURES)


def _flag(pred: Column) -> Column:
    return F.coalesce(pred, F.lit(False))


def add_behavior_indicators(txn: DataFrame) -> DataFrame:
    """Row-wise boolean indicators (null predicates count as false)."""
    amount_abs = F.abs(F.col(AMOUNT))
    hour = F.hour("transaction_datetime")
    return txn.withColumns(
        {
            "_is_online": _flag(F.col("channel") == "online"),
            "_is_offline": _flag(F.col("channel") == "offline"),
            "_is_recurring": F.col("Is_recurring").cast("boolean"),
            "_is_tokenized": F.col("tokenized").cast("boolean"),
            "_is_recurring_capable": F.col("recurring_capable").cast("boolean"),
            "_is_weekend": _flag(iso_weekday(F.col("transaction_date")) >= 6),
            "_is_night": _flag(hour.between(0, 5)),
            "_is_morning": _flag(hour.between(6, 11)),
            "_is_evening": _flag(hour.between(18, 23)),
            "_is_small_txn": _flag(amount_abs < SMALL_TRANSACTION_AMOUNT),
            "_is_large_txn": _flag(amount_abs >= LARGE_TRANSACTION_AMOUNT),
        }
    )


def share(indicator: str) -> Column:
    """Null-skipping mean of a boolean (``avg`` needs a number)."""
    return F.avg(F.col(indicator).cast("double"))


def nan_skipping_max(c: Column) -> Column:
    """``max`` that ignores NaN (Spark's ``max`` returns NaN if any is present)."""
    return F.max(F.nanvl(c, F.lit(None).cast("double")))


def activity_aggregates() -> list[Column]:
    amt = F.col(AMOUNT)
    return [
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum(amt).alias("total_amount"),
        F.avg(amt).alias("avg_amount"),
        nan_skipping_max(amt).alias("max_amount"),
        F.stddev_samp(amt).alias("std_amount"),
    ]


# distinct-count feature -> source column (non-null values counted)
DISTINCT_FEATURES = {
    "active_days": "transaction_date",
    "unique_merchants": "merchant_id",
    "unique_mcc": "mcc",
    "unique_countries": "country",
    "unique_merchant_countries": "merchant_country",
}


def distinct_counts(txn: DataFrame, names: list[str], window_rows: int = WINDOW_ROWS) -> DataFrame:
    """Exact distinct counts per card from a narrow projection, without multiplying the rows.

    Cards of at most ``window_rows`` rows, whose sets are bounded by that, gather one set per
    column in a single pass. The few larger ones are counted from distinct ``(card, column, value)``
    rows, which spread a hot card over all tasks before its count."""
    narrow = txn.select(CARD_ID_COLUMN, *(F.col(DISTINCT_FEATURES[n]).alias(n) for n in names))
    sizes = narrow.groupBy(CARD_ID_COLUMN).agg(F.count("*").alias("_n"))
    large = materialize(sizes.filter(F.col("_n") > window_rows).select(F.col(CARD_ID_COLUMN).alias("_card")), "large-cards")
    some_large = not large.isEmpty()
    small = narrow
    if some_large:
        side, _ = checked_broadcast(large)
        is_large = F.col(CARD_ID_COLUMN).eqNullSafe(F.col("_card"))
        small = narrow.join(side, is_large, "left_anti")
    sets = small.groupBy(CARD_ID_COLUMN).agg(*(F.size(F.collect_set(n)).cast("long").alias(n) for n in names))
    if not some_large:
        return sets
    each = F.array(*(F.struct(F.lit(n).alias("_column"), F.col(n).cast("string").alias("_value")) for n in names))
    rows = narrow.join(side, is_large, "left_semi").select(CARD_ID_COLUMN, F.inline(each))
    counted = rows.distinct().groupBy(CARD_ID_COLUMN).agg(
        *(F.count(F.when(F.col("_column") == n, F.col("_value"))).alias(n) for n in names)
    )
    return sets.unionByName(counted)


def share_aggregates(names: list[str]) -> list[Column]:
    by_feature = {v: k for k, v in SHARE_FEATURES.items()}
    return [share(by_feature[n]).alias(n) for n in names]


def card_ratios() -> dict[str, Column]:
    return {
        "transactions_per_active_day": guarded_ratio(
            F.col("total_transactions"), F.col("active_days")
        ),
        "merchant_diversity_ratio": guarded_ratio(
            F.col("unique_merchants"), F.col("total_transactions")
        ),
        "mcc_diversity_ratio": guarded_ratio(F.col("unique_mcc"), F.col("total_transactions")),
        "amount_cv": guarded_ratio(
            F.col("std_amount"),
            F.abs(F.col("avg_amount")),
            when_positive=F.abs(F.col("avg_amount")) > 0,
        ),
    }


def fill_numeric_nulls(df: DataFrame, value: float = 0) -> DataFrame:
    """``coalesce(c, 0)`` on every numeric column.

    Not ``na.fill``: that also replaces NaN, which must survive.
    """
    from pyspark.sql import types as T

    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(value).cast(df.schema[c].dataType)) for c in numeric}
    )


def card_aggregates(txn: DataFrame, blocks: list[str]) -> DataFrame:
    """Card-level aggregates for the requested feature blocks (wide pass, plus the
    narrow distinct and median passes when the blocks need them). Pass a
    materialized ``txn`` so that the passes do not repeat the upstream plan."""
    require_columns(txn, FEATURE_REQUIRED_COLUMNS, "prepared transactions")
    ind = add_behavior_indicators(txn)
    aggs: list[Column] = [F.max(TARGET_COLUMN).cast("byte").alias(TARGET_COLUMN)]
    with_activity = "activity" in blocks or "ratios" in blocks
    distinct: list[str] = []
    if with_activity:
        aggs += activity_aggregates()
        distinct.append("active_days")
    if "diversity" in blocks or "ratios" in blocks:
        distinct += DIVERSITY_FEATURES
    if "channel" in blocks:
        aggs += share_aggregates(CHANNEL_SHARES)
    if "time" in blocks:
        aggs += share_aggregates(TIME_SHARES)
    if "amount" in blocks:
        aggs += share_aggregates(AMOUNT_SHARES)
    out = ind.groupBy(CARD_ID_COLUMN).agg(*aggs)
    if distinct:
        out = out.join(distinct_counts(txn, distinct), CARD_ID_COLUMN, "left")
    if "activity" in blocks:
        median = group_median_exact(txn, CARD_ID_COLUMN, AMOUNT, "median_amount")
        out = out.join(median, CARD_ID_COLUMN, "left")
    return out


def card_labels(txn: DataFrame) -> DataFrame:
    """``card_number, label`` alone: one aggregate of two columns, for steps that need no features."""
    labels = txn.groupBy(CARD_ID_COLUMN).agg(F.max(TARGET_COLUMN).cast("byte").alias(TARGET_COLUMN))
    return fill_numeric_nulls(labels)


def _materialized_input(txn: DataFrame) -> DataFrame:
    require_columns(txn, FEATURE_REQUIRED_COLUMNS, "prepared transactions")
    return materialize(txn.select(*FEATURE_REQUIRED_COLUMNS), "prepared-transactions")


def build_card_level_features(
    txn: DataFrame, materialize_input: bool = True
) -> DataFrame:
    """All 26 features + label per card, nulls filled with 0.

    The prepared transactions feed three passes; by default the columns they
    need are written once as a parquet table under the checkpoint folder
    (:func:`cardlens.operators.materialize.materialize`) so the upstream
    cleaning and joins run once. Not globally sorted: a total order is only
    imposed at sinks.
    """
    if materialize_input:
        txn = _materialized_input(txn)
    agg = card_aggregates(txn, ["activity", "diversity", "channel", "time", "amount", "ratios"])
    out = fill_numeric_nulls(agg.withColumns(card_ratios()))
    return out.select(CARD_ID_COLUMN, TARGET_COLUMN, *CARD_FEATURES)


def card_feature_block(txn: DataFrame, block: str) -> DataFrame:
    """A subset of the feature set (same plan shape, fewer aggregates)."""
    cols = {
        "activity": ACTIVITY_FEATURES,
        "diversity": DIVERSITY_FEATURES,
        "channel": CHANNEL_SHARES,
        "time": TIME_SHARES,
        "amount": AMOUNT_SHARES,
        "ratios": RATIO_FEATURES,
    }[block]
    if block in ("activity", "ratios", "diversity"):
        # several passes: read the prepared columns from one copy
        txn = _materialized_input(txn)
    agg = card_aggregates(txn, [block])
    if block == "ratios":
        agg = agg.withColumns(card_ratios())
    return fill_numeric_nulls(agg).select(CARD_ID_COLUMN, TARGET_COLUMN, *cols)
