"""Prepared transactions laid out by card, for features without a shuffle.

:func:`write_layout` shuffles the prepared transactions once and writes them bucketed by card, one file per
bucket. Every later pass over them (the wide aggregate, the distinct counts, the median, the joins of
their results, and any other grouping by card) finds a card's rows in one task already, so
:func:`layout_features` has no exchange above the scan. It pays off where the same transactions are read more
than once.

A card of more than ``large_rows`` transactions would make its bucket's task as long as the card. Such cards are
counted first and written to a plain table beside the buckets; their features come from the passes of
:mod:`cardlens.operators.features`, which spread a card over all tasks. Both parts together are the same
rows as :func:`cardlens.operators.features.build_card_level_features` gives.

A layout is a folder with three tables: ``ordinary`` (bucketed), ``large`` and ``layout`` (one row: number of
buckets). :func:`open_layout` registers a written one in a new session; no metastore needs to remember it.

Defined cases: no transactions give an empty layout; transactions without a card are one group like any
other, as in the features themselves; the folder must not exist yet.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.config import CARD_ID_COLUMN, FEATURE_REQUIRED_COLUMNS
from cardlens.operators.clean import require_columns
from cardlens.operators.features import build_card_level_features
from cardlens.operators.joins import checked_broadcast
from cardlens.operators.materialize import materialize
from cardlens.operators.selection import WINDOW_ROWS

BUCKET_ROWS = 2_000_000  # transactions of one bucket, about
MOST_BUCKETS = 100_000  # the most that Spark accepts by default


@dataclass(frozen=True)
class Layout:
    """``ordinary`` transactions come with their partitioning by card; ``large`` is empty as a rule."""

    ordinary: DataFrame
    large: DataFrame
    buckets: int


def bucket_count(rows: int, least: int, bucket_rows: int = BUCKET_ROWS) -> int:
    return min(MOST_BUCKETS, max(least, -(-rows // bucket_rows), 1))


def _table_name() -> str:
    return f"cardlens_layout_{uuid.uuid4().hex}"


def write_layout(
    txn: DataFrame, path: str, large_rows: int = WINDOW_ROWS, buckets: int | None = None
) -> Layout:
    """Write the columns that the features need to ``path`` and return the layout. The number of buckets
    follows the rows unless it is given. ``txn`` is read twice (cards alone, then all): pass a written table
    where its plan is long."""
    require_columns(txn, FEATURE_REQUIRED_COLUMNS, "prepared transactions")
    spark, path = txn.sparkSession, path.rstrip("/")
    txn = txn.select(*FEATURE_REQUIRED_COLUMNS)
    sizes = materialize(txn.groupBy(F.col(CARD_ID_COLUMN).alias("_card")).agg(F.count("*").alias("_n")), "card-sizes")
    hot = sizes.filter(F.col("_n") > large_rows).select("_card")
    if buckets is None:
        rows = sizes.agg(F.sum("_n")).first()[0] or 0
        buckets = bucket_count(rows, spark.sparkContext.defaultParallelism)
    ordinary, large = txn, txn.limit(0)
    if not hot.isEmpty():
        side, _ = checked_broadcast(hot)
        is_large = F.col(CARD_ID_COLUMN).eqNullSafe(F.col("_card"))
        ordinary, large = txn.join(side, is_large, "left_anti"), txn.join(side, is_large, "left_semi")
    large.write.mode("error").parquet(f"{path}/large")
    by_card = ordinary.repartition(buckets, CARD_ID_COLUMN).write.mode("error").format("parquet")
    name = _table_name()
    by_card.bucketBy(buckets, CARD_ID_COLUMN).sortBy(CARD_ID_COLUMN).option("path", f"{path}/ordinary").saveAsTable(name)
    # written last: a folder without it is an unfinished layout
    spark.range(1).select(F.lit(buckets).alias("buckets")).write.mode("error").parquet(f"{path}/layout")
    return Layout(spark.table(name), spark.read.parquet(f"{path}/large"), buckets)


def open_layout(spark: SparkSession, path: str) -> Layout:
    """A layout that :func:`write_layout` finished, in this or an earlier session."""
    path = path.rstrip("/")
    buckets = spark.read.parquet(f"{path}/layout").first()["buckets"]
    large, name = spark.read.parquet(f"{path}/large"), _table_name()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in large.schema.fields)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({CARD_ID_COLUMN}) SORTED BY ({CARD_ID_COLUMN}) INTO {buckets} BUCKETS LOCATION '{path}/ordinary'"
    )
    return Layout(spark.table(name), large, buckets)


def layout_features(layout: Layout) -> DataFrame:
    """All 26 features and the label per card; the ordinary cards' without an exchange."""
    ordinary = build_card_level_features(layout.ordinary, materialize_input=False)
    if layout.large.isEmpty():
        return ordinary
    return ordinary.unionByName(build_card_level_features(layout.large, materialize_input=False))
