"""Dimension joins: broadcast only after the dimension's size is checked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from cardlens.operators.materialize import materialize

_DEFAULT_MAX_BYTES = 10 * 1024 * 1024
# rows of one key that a task may take; most keys that can be hot; most parts of one key
HOT_ROWS = 1_000_000
MOST_HOT = 10_000
MOST_SALTS = 100_000


def _parse_bytes(text: str | None) -> int:
    if not text:
        return _DEFAULT_MAX_BYTES
    t = text.strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for suffix in sorted(units, key=len, reverse=True):
        if t.endswith(suffix):
            return int(float(t[: -len(suffix)]) * units[suffix])
    return int(t)


def broadcast_limit_bytes(df: DataFrame) -> int:
    """The session's broadcast threshold (``-1`` disables broadcasting)."""
    conf = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    return _parse_bytes(conf)


_WIDTH = {
    "byte": 1, "short": 2, "integer": 4, "long": 8, "float": 4, "double": 8,
    "boolean": 1, "date": 4, "timestamp": 8, "timestamp_ntz": 8,
}


def row_width_estimate(df: DataFrame) -> int:
    """Bytes per row from the schema (Spark's default sizes; strings count 20,
    decimals 16, nested and other types 64)."""
    width = 0
    for f in df.schema.fields:
        name = f.dataType.typeName()
        if name == "string":
            width += 20
        elif name.startswith("decimal"):
            width += 16
        else:
            width += _WIDTH.get(name, 64)
    return max(8, width)


def measured_bytes(dim: DataFrame) -> int:
    """One aggregate over the dimension: rows x fixed-width columns plus the
    actual bytes of its string columns."""
    strings = [f.name for f in dim.schema.fields if f.dataType.typeName() == "string"]
    fixed = row_width_estimate(dim.drop(*strings)) if len(strings) < len(dim.columns) else 0
    aggs = [F.count(F.lit(1)).alias("n")]
    if strings:
        total = sum((F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c in strings), F.lit(0))
        aggs.append(F.sum(total).alias("text_bytes"))
    row = dim.agg(*aggs).first()
    text = (row["text_bytes"] or 0) if strings else 0
    return int(row["n"]) * fixed + int(text)


def checked_broadcast(dim: DataFrame, max_bytes: int | None = None) -> tuple[DataFrame, bool]:
    """Return (dim, broadcast?) after measuring the dimension.

    The dimension is written once (:func:`materialize`) and measured from there by
    one aggregate, so nothing stays persisted whatever the outcome. It is marked
    for broadcast only when the measured size fits the limit (default: the session's
    broadcast threshold); otherwise the caller's join shuffles both sides.
    """
    limit = broadcast_limit_bytes(dim) if max_bytes is None else max_bytes
    if limit <= 0:
        return dim, False
    dim = materialize(dim, "dimension")
    return (F.broadcast(dim), True) if measured_bytes(dim) <= limit else (dim, False)


def hot_keys(fact: DataFrame, on: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``_hot, _salts``: keys of at least ``hot_rows`` rows, and over how many parts their rows are to be spread.

    Counted exactly, from the key column alone, with partial aggregates. A key must also hold one row in
    ``MOST_HOT`` of all, so there are at most that many: a bound that does not grow with the data, while
    a key below it is too small to hold a task up."""
    counts = materialize(fact.filter(F.col(on).isNotNull()).groupBy(F.col(on).alias("_hot")).agg(F.count("*").alias("_n")), "keys")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    least = max(hot_rows, total / MOST_HOT)
    salts = F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int")
    return counts.filter(F.col("_n") >= least).select("_hot", F.least(salts, F.lit(MOST_SALTS)).alias("_salts"))


def _salt(fact: DataFrame) -> Column:
    """A number that a recomputed task gives a row again whatever the order of its rows, and that
    differs between equal rows of different tasks."""
    plain = [f.name for f in fact.schema.fields if isinstance(f.dataType, AtomicType)]
    return F.xxhash64(*(F.col(f"`{c}`") for c in plain), F.spark_partition_id())


def salted_left_join(fact: DataFrame, dim: DataFrame, on: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left join by shuffles in which no key's rows meet in one task: rows of a hot key are spread over
    parts, and the dimension's rows of that key are repeated once per part. Rows without a key go around."""
    hot = materialize(hot_keys(fact, on, hot_rows), "hot-keys")
    keyed, bare = fact.filter(F.col(on).isNotNull()), fact.filter(F.col(on).isNull())
    if hot.isEmpty():
        joined = keyed.join(dim, on=on, how="left")
    else:
        hot = F.broadcast(hot)  # at most MOST_HOT keys
        order = [*fact.columns, *(c for c in dim.columns if c != on)]
        rows = keyed.withColumn("_part", _salt(keyed)).join(hot, F.col(on) == F.col("_hot"), "left")
        rows = rows.withColumn("_part", F.coalesce(F.pmod("_part", "_salts"), F.lit(0)).cast("int")).drop("_hot", "_salts")
        parts = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
        side = dim.join(hot, F.col(on) == F.col("_hot"), "left").withColumn("_part", F.explode(parts)).drop("_hot", "_salts")
        joined = rows.join(side, on=[on, "_part"], how="left").drop("_part")
        joined = joined.select(on, *(c for c in order if c != on))
    return joined.unionByName(bare, allowMissingColumns=True)


def join_dimension(
    fact: DataFrame, dim: DataFrame, on: str, how: str = "left", max_bytes: int | None = None
) -> DataFrame:
    """Left join of a dimension on one column: broadcast when it is measured small.

    Beyond that :func:`salted_left_join`. Other kinds of join shuffle both sides as they are."""
    side, small = checked_broadcast(dim, max_bytes)
    if small or how != "left":
        return fact.join(side, on=on, how=how)
    return salted_left_join(fact, side, on)
