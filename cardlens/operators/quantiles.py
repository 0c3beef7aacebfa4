"""Exact order statistics per group.

Nearest-rank quantile (Polars' default ``nearest`` rule): the value at
0-based position ``round_half_up(q * (n - 1))`` of the group's non-null
values in ascending order. Positions are found by
:func:`cardlens.operators.selection.order_statistics`: a bounded window for ordinary
groups, narrowing by counts for large ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.operators.selection import order_statistics


def nearest_rank_position(q: float, n: Column) -> Column:
    """0-based position of the nearest-rank quantile among n sorted values."""
    return F.round(F.lit(float(q)) * (n - 1).cast("double"), 0).cast("long")


def group_quantile_nearest(
    df: DataFrame,
    group: str | list[str],
    value: str,
    q: float,
    out: str,
) -> DataFrame:
    """One row per group with a non-null value: ``(*group, out)``.

    ``group`` is one key column or several.
    """
    keys = [group] if isinstance(group, str) else list(group)
    known = df.select(*keys, F.nanvl(F.col(value), F.lit(None).cast("double")).alias("_value"))
    return order_statistics(known, keys, "_value", {out: lambda n: nearest_rank_position(q, n)})


def group_median_exact(df: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """Exact median per group (mean of the two middle values when n is even).

    NaN sorts above every number (as in Spark's ordering); only nulls are skipped.
    """
    middle = {
        "_v_lo": lambda n: F.floor((n - 1) / 2).cast("long"),
        "_v_hi": lambda n: F.ceil((n - 1) / 2).cast("long"),
    }
    found = order_statistics(df, [group], value, middle)
    return found.select(group, (F.col("_v_lo") * 0.5 + F.col("_v_hi") * 0.5).alias(out))
