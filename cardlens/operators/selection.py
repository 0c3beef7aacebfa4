"""Exact order statistics by narrowing value ranges: counts only.

A value at a given position of a group is found without sorting the group:

* Groups of at most ``WINDOW_ROWS`` values are ordered in a window, one shuffle of
  ``(group, value)``: no task holds more than that of a group.
* Larger groups (at most ``rows / WINDOW_ROWS`` of them) are narrowed. Their range of
  values is cut into ``DIGITS`` equal parts; the parts' counts (partial aggregates, at most
  ``DIGITS`` rows a group) tell which part holds the position; its least and greatest
  value are the next range. It ends when they are equal, as a rule after two or three
  rounds, and always, because least and greatest never share a part. A value that
  a third of all rows hold is one count. Nothing is range-partitioned, sampled, or gathered.

:func:`pairs_below` counts the pairs that ROC AUC needs by the same cuts, over all parts at once.

Order: minus infinity, finite numbers, infinity, NaN (as Spark sorts doubles).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlens.operators.joins import checked_broadcast
from cardlens.operators.materialize import materialize

WINDOW_ROWS = 65_536
DIGITS = 8_192


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[f"_{k}"]) for k in keys))


def _renamed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"_{k}" for k in keys})


def _finite(v: Column) -> Column:
    return ~F.isnan(v) & (F.abs(v) < float("inf"))


def _magnitude(v: Column) -> Column:
    """Sign and binary logarithm, as one number that never falls as ``v`` rises (2^-1074 is the least)."""
    return F.when(v == 0, F.lit(0.0)).otherwise(F.signum(v) * (F.log2(F.abs(v)) + 1075))


def digit(v: Column, low: Column, high: Column, digits: int) -> Column:
    """Part 0 .. digits-1 of the range ``low`` to ``high`` that a value lies in: never falls as
    the value rises; ``low`` is in the first and ``high`` in the last part. Infinities and NaN
    have parts of their own. Ranges over several powers of two are cut by magnitude, narrow ones
    linearly; halves keep the latter from overflowing."""
    linear = F.try_divide(v * 0.5 - low * 0.5, high * 0.5 - low * 0.5)
    by_size = F.try_divide(_magnitude(v) - _magnitude(low), _magnitude(high) - _magnitude(low))
    narrow = (F.signum(low) == F.signum(high)) & (F.abs(high) * 0.25 <= F.abs(low)) & (F.abs(low) * 0.25 <= F.abs(high))
    part = F.when(narrow, linear).otherwise(by_size) * digits
    inner = F.least(F.greatest(F.floor(part), F.lit(0)), F.lit(digits - 2))
    return (
        F.when(F.isnan(v), digits + 1)
        .when(v == float("inf"), digits)
        .when(v == float("-inf"), -1)
        .when(v >= high, digits - 1)
        .when(v <= low, 0)
        .otherwise(inner)
        .cast("int")
    )


def _narrowed(values: DataFrame, wanted: DataFrame, keys: list[str], digits: int) -> DataFrame:
    """One round: ``wanted`` (keys, _name, _rank, _low, _high) with ranks and ranges of the part
    that holds each."""
    side, _ = checked_broadcast(_renamed(wanted, keys))
    rows = values.join(side, _same(values, side, keys))
    v = F.col("_v")
    # the first round takes all values, infinities and NaN too
    rows = rows.filter(F.col("_all") | ((v >= F.col("_low")) & (v <= F.col("_high"))))
    part = digit(v, F.col("_low"), F.col("_high"), digits)
    parts = rows.groupBy(*keys, "_name", "_rank", part.alias("_part")).agg(
        F.sum("_w").alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most")
    )
    order = Window.partitionBy(*keys, "_name").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(order), F.lit(0)))
    hit = (F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_n"))
    return parts.filter(hit).select(
        *keys,
        "_name",
        (F.col("_rank") - F.col("_before")).alias("_rank"),
        F.col("_least").alias("_low"),
        F.col("_most").alias("_high"),
        F.lit(False).alias("_all"),
    )


def _by_narrowing(
    values: DataFrame, large: DataFrame, keys: list[str], positions: dict[str, Callable], digits: int
) -> DataFrame:
    """``keys, _name, _v`` of the large groups (keys, _n, _low, _high)."""
    each = F.array(*(F.struct(F.lit(name).alias("_name"), at(F.col("_n")).alias("_rank")) for name, at in positions.items()))
    wanted = large.select(*keys, "_low", "_high", F.inline(each), F.lit(True).alias("_all"))
    found = []
    while True:
        state = materialize(_narrowed(values, wanted, keys, digits), "ranges")
        # NaN equals NaN here
        done = F.col("_low") == F.col("_high")
        found.append(state.filter(done).select(*keys, "_name", F.col("_low").alias("_v")))
        wanted = state.filter(~done)
        if wanted.isEmpty():
            return reduce(DataFrame.unionByName, found)


def order_statistics(
    df: DataFrame,
    keys: list[str],
    value: str,
    positions: dict[str, Callable[[Column], Column]],
    window_rows: int = WINDOW_ROWS,
    digits: int = DIGITS,
    weight: str | None = None,
) -> DataFrame:
    """``keys`` and per name in ``positions`` the value at that 0-based position (a function of the
    group's number of values) among the group's non-null values; groups without a value are absent.
    ``weight`` names a column with the number of times that a row's value counts (one at least).

    ``df`` is read once or twice more when large groups exist: pass a written table where its plan is long."""
    v = F.col("_v")
    times = F.lit(1) if weight is None else F.col(weight)
    values = df.select(*keys, F.col(value).cast("double").alias("_v"), times.cast("long").alias("_w")).filter(v.isNotNull())
    number = F.when(_finite(v), v)
    sizes = values.groupBy(*keys).agg(
        F.count("*").alias("_rows"),
        F.sum("_w").alias("_n"),
        F.coalesce(F.min(number), F.lit(0.0)).alias("_low"),
        F.coalesce(F.max(number), F.lit(0.0)).alias("_high"),
    )
    large = materialize(sizes.filter(F.col("_rows") > window_rows), "large-groups")
    some_large = not large.isEmpty()
    small = values
    if some_large:
        side, _ = checked_broadcast(_renamed(large.select(*keys), keys))
        small = values.join(side, _same(values, side, keys), "left_anti")
    group = Window.partitionBy(*keys)
    up_to = group.orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = small.withColumn("_to", F.sum("_w").over(up_to)).withColumn("_n", F.sum("_w").over(group))
    at = {
        name: (position(F.col("_n")) < F.col("_to")) & (position(F.col("_n")) >= F.col("_to") - F.col("_w"))
        for name, position in positions.items()
    }
    ranked = ranked.filter(reduce(lambda a, b: a | b, at.values()))
    out = ranked.groupBy(*keys).agg(*(F.max(F.when(c, v)).alias(name) for name, c in at.items()))
    if not some_large:
        return out
    found = _by_narrowing(values, large, keys, positions, digits)
    found = found.groupBy(*keys).agg(*(F.max(F.when(F.col("_name") == name, v)).alias(name) for name in positions))
    return out.unionByName(found)


def pairs_below(
    scores: DataFrame, window_rows: int = WINDOW_ROWS, digits: int = DIGITS
) -> float:
    """Sum over the distinct scores (``_v, _pos, _neg``, one row each) of ``_pos`` times the ``_neg`` of
    smaller scores, equal ones counted half: written scores, one pass per round.

    Every round cuts the ranges that still hold more than ``window_rows`` scores into parts. Pairs of
    different parts are counted from the parts' sums, those inside small parts by a window over each."""
    total = float(scores.agg(F.sum(F.col("_pos") * F.col("_neg") / 2.0)).first()[0] or 0.0)
    rows = scores.withColumn("_node", F.lit("0"))

    def below(rows: DataFrame, by: str, order: str) -> float:
        w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        with_neg = rows.withColumn("_below", F.sum("_neg").over(w))
        return float(with_neg.agg(F.sum(F.col("_pos").cast("double") * F.col("_below"))).first()[0] or 0.0)

    while True:
        number = F.when(_finite(F.col("_v")), F.col("_v"))
        nodes = rows.groupBy("_node").agg(
            F.count("*").alias("_n"),
            F.coalesce(F.min(number), F.lit(0.0)).alias("_low"),
            F.coalesce(F.max(number), F.lit(0.0)).alias("_high"),
        )
        nodes = nodes.withColumnRenamed("_node", "_of")
        side, _ = checked_broadcast(nodes.filter(F.col("_n") > window_rows))
        if side.isEmpty():
            return total + below(rows, "_node", "_v")
        small = rows.join(side, F.col("_node") == F.col("_of"), "left_anti")
        total += below(small, "_node", "_v")
        cut = rows.join(side, F.col("_node") == F.col("_of"))
        cut = cut.withColumn("_part", digit(F.col("_v"), F.col("_low"), F.col("_high"), digits))
        cut = materialize(cut.select("_v", "_pos", "_neg", "_node", "_part"), "score-parts")
        parts = cut.groupBy("_node", "_part").agg(F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"))
        total += below(parts, "_node", "_part")
        rows = cut.withColumn("_node", F.concat_ws("/", "_node", "_part")).drop("_part")
