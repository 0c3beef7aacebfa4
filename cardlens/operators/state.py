"""Card features from daily partial states: a new or late day costs that day alone.

Per day of transactions three tables hold what all features can be merged from:

* ``totals``: one row per day and card with count, sum, mean, squared deviations, maximum,
  label, and of each indicator the true and the known rows;
* ``values``: rows per day, card, column and value of the columns counted as distinct;
* ``amounts``: rows per day, card and amount, from which the exact median comes;
* ``sketches`` (opt-in, :func:`update_sketches`): HyperLogLog and KLL sketches per day and card, of fixed size, for
  estimates without the other two tables.

All are partitioned by ``state_day``. :func:`update_states` replaces the partitions of the days it is
given and reads no other day; :func:`merge_features` gives the same rows as
:func:`cardlens.operators.features.build_card_level_features` over all transactions.

A day is replaced as a whole, so an update brings all transactions of its days. Transactions
without a date form a day of their own (null). A day whose transactions are all gone keeps its
state until :func:`drop_days`. Every aggregation has a map-side partial; lists gathered per
card have one entry per day.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.config import CARD_ID_COLUMN, FEATURE_REQUIRED_COLUMNS, TARGET_COLUMN
from cardlens.operators import features as C
from cardlens.operators.clean import require_columns
from cardlens.operators.selection import order_statistics

DAY = "state_day"
DAY_COLUMN = "transaction_date"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
TABLES = ("totals", "values", "amounts", "sketches")
# settings of the sketches: relative standard error of 1.6 %, rank error of about 1.7 %
HLL_LOG_BUCKETS = 12
KLL_SIZE = 200

_VALUES = {n: c for n, c in C.DISTINCT_FEATURES.items() if c != DAY_COLUMN}
_KEYS = [DAY, CARD_ID_COLUMN]


def _dated(txn: DataFrame) -> DataFrame:
    require_columns(txn, FEATURE_REQUIRED_COLUMNS, "prepared transactions")
    return txn.withColumn(DAY, F.col(DAY_COLUMN))


def daily_totals(txn: DataFrame) -> DataFrame:
    amount = F.col(C.AMOUNT)
    known = F.count(amount)
    shares = [
        agg
        for flag in C.INDICATOR_COLUMNS
        for agg in (F.count_if(F.col(flag)).alias(f"{flag}_true"), F.count(flag).alias(f"{flag}_known"))
    ]
    return (
        C.add_behavior_indicators(_dated(txn))
        .groupBy(*_KEYS)
        .agg(
            F.max(TARGET_COLUMN).cast("byte").alias(TARGET_COLUMN),
            F.count(F.lit(1)).alias("rows"),
            known.alias("known"),
            F.sum(amount).alias("total"),
            F.avg(amount).alias("mean"),
            (F.var_pop(amount) * known).alias("deviations"),
            C.nan_skipping_max(amount).alias("largest"),
            *shares,
        )
    )


def daily_values(txn: DataFrame) -> DataFrame:
    each = F.array(*(F.struct(F.lit(n).alias("feature"), F.col(c).cast("string").alias("value")) for n, c in _VALUES.items()))
    rows = _dated(txn).select(*_KEYS, F.inline(each)).filter(F.col("value").isNotNull())
    return rows.groupBy(*_KEYS, "feature", "value").agg(F.count(F.lit(1)).alias("rows"))


def daily_amounts(txn: DataFrame) -> DataFrame:
    rows = _dated(txn).select(*_KEYS, F.col(C.AMOUNT).cast("double").alias("amount"))
    return rows.filter(F.col("amount").isNotNull()).groupBy(*_KEYS, "amount").agg(F.count(F.lit(1)).alias("rows"))


def daily_sketches(txn: DataFrame) -> DataFrame:
    counts = [F.hll_sketch_agg(F.col(c).cast("string"), HLL_LOG_BUCKETS).alias(n) for n, c in C.DISTINCT_FEATURES.items()]
    amounts = F.kll_sketch_agg_double(F.col(C.AMOUNT).cast("double"), F.lit(KLL_SIZE)).alias("amounts")
    return _dated(txn).groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("rows"), *counts, amounts)


def _of_days(days: list) -> Column:
    """Rows of some days (null: without a date); a plain comparison, so that a partitioned source is pruned."""
    dated = [d for d in days if d is not None]
    tests = [F.col(DAY_COLUMN).isin(dated)] if dated else []
    if len(dated) < len(days):
        tests.append(F.col(DAY_COLUMN).isNull())
    return reduce(Column.__or__, tests, F.lit(False))


def _replace(table: DataFrame, path: str) -> None:
    """Only the partitions that ``table`` has are replaced."""
    table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def _chosen(txn: DataFrame, days: list | None) -> DataFrame:
    return txn if days is None else txn.filter(_of_days(days))


def update_states(txn: DataFrame, path: str, days: list | None = None) -> None:
    """Write the states of ``days`` (dates, null for transactions without one; by default every day of
    ``txn``) to ``path``; partitions of other days are neither read nor touched."""
    rows = _chosen(txn, days)
    for name, build in (("totals", daily_totals), ("values", daily_values), ("amounts", daily_amounts)):
        _replace(build(rows), f"{path}/{name}")


def update_sketches(txn: DataFrame, path: str, days: list | None = None) -> None:
    """Likewise for the table of sketches."""
    _replace(daily_sketches(_chosen(txn, days)), f"{path}/sketches")


def drop_days(spark: SparkSession, path: str, days: list) -> None:
    """Remove the states of days that have no transactions any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in TABLES:
        for day in days:
            folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{name}/{DAY}={NO_DAY if day is None else day}")
            folder.getFileSystem(conf).delete(folder, True)


def read_state(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}").withColumn(DAY, F.col(DAY).cast("date"))


def _spread(days: Column) -> Column:
    """Sum of squared deviations from the mean of all days, from each day's own (count, mean, deviations)."""

    def add(acc: Column, day: Column) -> Column:
        n = acc["known"] + day["known"]
        step = day["mean"] - acc["mean"]
        return F.struct(
            n.alias("known"),
            (acc["mean"] + step * day["known"] / n).alias("mean"),
            (acc["deviations"] + day["deviations"] + step * step * acc["known"] * day["known"] / n).alias("deviations"),
        )

    zero = F.struct(F.lit(0).cast("long").alias("known"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("deviations"))
    return F.aggregate(days, zero, add, lambda acc: acc["deviations"])


def merge_totals(totals: DataFrame) -> DataFrame:
    day = F.struct(DAY, "known", "mean", "deviations")
    known = F.sum("known")
    shares = [
        F.try_divide(F.sum(f"{flag}_true").cast("double"), F.sum(f"{flag}_known")).alias(name)
        for flag, name in C.SHARE_FEATURES.items()
    ]
    merged = totals.groupBy(CARD_ID_COLUMN).agg(
        F.max(TARGET_COLUMN).alias(TARGET_COLUMN),
        F.sum("rows").alias("total_transactions"),
        F.sum("total").alias("total_amount"),
        F.try_divide(F.sum("total"), known).alias("avg_amount"),
        F.max("largest").alias("max_amount"),
        known.alias("_known"),
        F.count(DAY).alias("active_days"),
        F.array_sort(F.collect_list(F.when(F.col("known") > 0, day))).alias("_days"),
        *shares,
    )
    spread = F.when(F.col("_known") > 1, F.sqrt(_spread(F.col("_days")) / (F.col("_known") - 1)))
    return merged.withColumn("std_amount", spread).drop("_days", "_known")


def merge_distinct(values: DataFrame) -> DataFrame:
    """Distinct values per card: rows are told apart before a card is counted, so a hot card stays spread."""
    rows = values.select(CARD_ID_COLUMN, "feature", "value").distinct()
    return rows.groupBy(CARD_ID_COLUMN).agg(*(F.count_if(F.col("feature") == n).alias(n) for n in _VALUES))


def merge_median(amounts: DataFrame, **bounds) -> DataFrame:
    middle = {
        "_low_middle": lambda n: F.floor((n - 1) / 2).cast("long"),
        "_high_middle": lambda n: F.ceil((n - 1) / 2).cast("long"),
    }
    found = order_statistics(amounts, [CARD_ID_COLUMN], "amount", middle, weight="rows", **bounds)
    return found.select(CARD_ID_COLUMN, (F.col("_low_middle") * 0.5 + F.col("_high_middle") * 0.5).alias("median_amount"))


def merge_features(spark: SparkSession, path: str) -> DataFrame:
    """All 26 features and the label per card, from the states of all days."""
    out = merge_totals(read_state(spark, path, "totals"))
    out = out.join(merge_distinct(read_state(spark, path, "values")), CARD_ID_COLUMN, "left")
    out = out.join(merge_median(read_state(spark, path, "amounts")), CARD_ID_COLUMN, "left")
    counts = {n: F.coalesce(F.col(n), F.lit(0).cast("long")) for n in _VALUES}
    out = C.fill_numeric_nulls(out.withColumns(counts).withColumns(C.card_ratios()))
    return out.select(CARD_ID_COLUMN, TARGET_COLUMN, *C.CARD_FEATURES)


def merge_sketches(sketches: DataFrame, quantiles: dict[str, float]) -> DataFrame:
    """Per card the estimated distinct counts and the estimated amounts at ``quantiles`` (name: rank);
    cards without an amount have null there."""
    counts = [F.hll_sketch_estimate(F.hll_union_agg(n)).alias(n) for n in C.DISTINCT_FEATURES]
    merged = sketches.groupBy(CARD_ID_COLUMN).agg(
        F.sum("rows").alias("total_transactions"), *counts, F.kll_merge_agg_double("amounts").alias("_amounts")
    )
    some = F.kll_sketch_get_n_double("_amounts") > 0
    at = {n: F.when(some, F.kll_sketch_get_quantile_double("_amounts", F.lit(q))) for n, q in quantiles.items()}
    return merged.withColumns(at).drop("_amounts")
