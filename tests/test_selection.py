"""Positions by narrowing against sorted lists: hot groups, ties, the whole range of doubles,
with windows and digits so small that every path runs."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from cardlens.operators import selection

POSITIONS = {
    "first": lambda n: F.lit(0).cast("long"),
    "middle": lambda n: F.floor(n / 2).cast("long"),
    "last": lambda n: (n - 1).cast("long"),
}


def key(v):
    return (math.isnan(v), v if not math.isnan(v) else 0.0)


def want(rows):
    groups = {}
    for *k, v in rows:
        if v is not None:
            groups.setdefault(tuple(k), []).append(v)
    out = {}
    for k, values in groups.items():
        s = sorted(values, key=key)
        out[k] = (s[0], s[len(s) // 2], s[-1])
    return out


def got(df, window_rows, digits):
    out = selection.order_statistics(df, ["g", "s"], "v", POSITIONS, window_rows, digits)
    return {(r.g, r.s): (r["first"], r.middle, r.last) for r in out.collect()}


def doubles(rnd):
    while True:
        v = struct.unpack("<d", struct.pack("<Q", rnd.getrandbits(64)))[0]
        if not math.isnan(v):
            yield v


@pytest.mark.parametrize(("window_rows", "digits"), [(10, 64), (10**6, 8192)])
def test_positions(spark, window_rows, digits):
    rnd = random.Random(1)
    any_double = doubles(rnd)
    rows = [("hot", 1, float(rnd.randint(0, 40))) for _ in range(1500)]
    rows += [("same", 1, 7.25)] * 900
    rows += [("wide", 1, next(any_double)) for _ in range(300)]
    rows += [("wide", 2, v) for v in (1.7e308, -1.7e308, 5e-324, 1e-323, 0.0, 1.0) for _ in range(8)]
    rows += [("odd", 1, v) for v in (float("nan"), float("inf"), float("-inf"), 2.0, 3.0) for _ in range(9)]
    rows += [("nan", 1, float("nan"))] * 40
    rows += [(None, 3, float(i)) for i in range(90)] + [(None, None, 1.5)]
    rows += [(f"g{i % 50}", 0, rnd.random()) for i in range(400)] + [("none", 0, None)]
    df = spark.createDataFrame(rows, "g string, s int, v double").repartition(6)
    assert repr(sorted(got(df, window_rows, digits).items(), key=repr)) == repr(sorted(want(rows).items(), key=repr))


def test_empty(spark):
    df = spark.createDataFrame([], "g string, s int, v double")
    assert got(df, 10, 16) == {}


def test_digits_never_fall(spark):
    rnd = random.Random(2)
    v = sorted([rnd.uniform(-1e3, 1e3) for _ in range(500)] + [-1e3, 1e3])
    df = spark.createDataFrame([(x,) for x in v], "v double").orderBy("v")
    d = [r.d for r in df.select(selection.digit(F.col("v"), F.lit(-1e3), F.lit(1e3), 32).alias("d"), "v").orderBy("v").collect()]
    assert d == sorted(d) and d[0] == 0 and d[-1] == 31


def test_large_groups_shuffle_counts_only(spark):
    """The plan of a round has no range partitioning, and a window over at most ``digits`` rows a group."""
    df = spark.range(5000).select(F.lit("a").alias("g"), F.lit(1).alias("s"), (F.col("id") % 977).cast("double").alias("v"))
    out = selection.order_statistics(df, ["g", "s"], "v", POSITIONS, 100, 64)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    assert {(r.g, r["first"], r.middle, r.last) for r in out.collect()} == {("a", 0.0, 477.0, 976.0)}


@pytest.mark.parametrize(("window_rows", "digits"), [(20, 64), (10**6, 64)])
def test_pairs_below(spark, window_rows, digits):
    rnd = random.Random(3)
    values = [rnd.choice([rnd.random(), rnd.randint(0, 9) * 1.0, 1e-300 * rnd.random()]) for _ in range(300)]
    values = sorted({*values, float("inf"), float("-inf")})
    rows = [(v, rnd.randint(0, 4), rnd.randint(0, 4)) for v in values]
    df = spark.createDataFrame(rows, "_v double, _pos long, _neg long").repartition(5)
    expected = sum(p * (sum(n for w, _, n in rows if w < v) + own / 2) for v, p, own in rows)
    assert selection.pairs_below(df, window_rows, digits) == expected
    assert selection.pairs_below(df.limit(0), window_rows, digits) == 0.0
