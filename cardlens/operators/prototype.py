"""The lazy scan -> label -> concat -> join -> time-indicator chain.

No cleaning: the raw segments are labelled (``target``), concatenated and
left-joined to the raw (not deduplicated) merchant reference, so a merchant
listed twice doubles its transactions, as in the source chain. Dimension
columns whose names clash with transaction columns get a ``_right`` suffix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.functions.parsing import iso_weekday, timestamp_expr
from cardlens.operators.enrich import concat_strict
from cardlens.operators.joins import join_dimension


def prototype_time_features(
    business: DataFrame, consumer: DataFrame, merchants: DataFrame
) -> DataFrame:
    bus = business.withColumn("target", F.lit(1))
    con = consumer.withColumn("target", F.lit(0))
    txn = concat_strict(bus, con)
    dim = merchants.select(
        F.col("merchant_id").cast("string").alias("merchant_id"),
        *[
            F.col(c).alias(f"{c}_right" if c in txn.columns else c)
            for c in merchants.columns
            if c != "merchant_id"
        ],
    )
    df = join_dimension(
        txn.withColumn("merchant_id", F.col("merchant_id").cast("string")), dim, "merchant_id", "left"
    )
    df = df.withColumn("dt", timestamp_expr(df, "transaction_timestamp"))
    df = df.withColumns({"hour": F.hour("dt"), "dayofweek": iso_weekday(F.col("dt"))})
    return df.withColumns(
        {
            "is_weekend": F.col("dayofweek").isin(6, 7).cast("int"),
            "is_business_hour": F.col("hour").between(9, 18).cast("int"),
        }
    )
