"""Distributed running totals in a declared order.

A running sum "over all rows of the group ordered by v" is a window whose
whole group is sorted in one task — fatal when one group (or the global
order) holds a large share of the data. :func:`ordered_cumulative` computes
the same numbers without that bottleneck:

1. range-partition the rows by ``(keys, order)`` — a hot group spans many
   partitions, each holding a contiguous slice of its order;
2. pin the assignment with a reliable ``checkpoint()`` (range bounds come
   from sampling; the pinned copy keeps both uses below consistent and cuts
   the lineage);
3. running sum inside each ``(partition, group)`` block;
4. block totals -> per-block offset = sum of earlier blocks of the group
   (a window over at most ``#partitions`` blocks per group);
5. join the offsets back on ``(partition, group)``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardlens.session import ensure_checkpoint_dir


def ordered_cumulative(
    df: DataFrame,
    keys: list[str],
    order: str,
    weight: str,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``_cum`` (inclusive) and ``_cum_before`` (exclusive) running sums of
    ``weight`` within each ``keys`` group in ascending ``order``.

    ``df`` must hold one row per ``(keys, order)`` value (pre-aggregate first).
    """
    ensure_checkpoint_dir(df.sparkSession)
    sort_cols = [*[F.col(k).asc_nulls_first() for k in keys], F.col(order)]
    # Without an explicit count AQE may coalesce adjacent ranges; coalesced
    # partitions are still contiguous and in order, which is all we need.
    ranged = (
        df.repartitionByRange(num_partitions, *sort_cols)
        if num_partitions
        else df.repartitionByRange(*sort_cols)
    )
    tagged = ranged.withColumn("_pid", F.spark_partition_id()).checkpoint()

    block = ["_pid", *keys]
    local_w = (
        Window.partitionBy(*block)
        .orderBy(F.col(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = tagged.withColumn("_local_cum", F.sum(weight).over(local_w))

    totals = tagged.groupBy(*block).agg(F.sum(weight).alias("_block_total"))
    before_w = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = totals.select(
        *[F.col(c).alias(f"_o{c}") for c in block],
        F.coalesce(F.sum("_block_total").over(before_w), F.lit(0)).alias("_offset"),
    )
    cond = reduce(lambda a, b: a & b, [local[c].eqNullSafe(offsets[f"_o{c}"]) for c in block])
    joined = local.join(offsets, cond)
    out = joined.withColumn("_cum", F.col("_offset") + F.col("_local_cum"))
    out = out.withColumn("_cum_before", F.col("_cum") - F.col(weight))
    return out.drop("_pid", "_local_cum", "_offset", *[f"_o{c}" for c in block])
