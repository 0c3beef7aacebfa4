"""Feature importance as a ranked DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlens.operators.model import feature_importance

IMPORTANCE_SCHEMA = T.StructType(
    [
        T.StructField("feature", T.StringType()),
        T.StructField("importance", T.DoubleType()),
        T.StructField("importance_type", T.StringType()),
    ]
)


def rank_importance(imp: DataFrame) -> DataFrame:
    """Rank from 1 by importance, descending (feature name breaks ties).

    The frame has one row per model feature (26), so the un-partitioned
    window is driver-sized by construction.
    """
    w = Window.orderBy(F.desc("importance"), F.asc("feature"))
    return imp.select(
        F.row_number().over(w).cast("int").alias("rank"), "feature", "importance", "importance_type"
    )


def get_feature_importance(spark: SparkSession, model, cols: list[str]) -> DataFrame:
    values, kind = feature_importance(model, cols)
    rows = [(c, float(v), kind) for c, v in zip(cols, values)]
    return rank_importance(spark.createDataFrame(rows, IMPORTANCE_SCHEMA))


def top_features(ranked: DataFrame, n: int) -> DataFrame:
    return ranked.orderBy("rank").limit(n)
