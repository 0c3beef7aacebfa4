import random

import numpy as np
from pyspark.sql import functions as F

from cardlens.operators.quantiles import group_quantile_nearest
from cardlens.operators.ranking import ordered_cumulative


def _brute_nearest(values, q):
    v = sorted(values)
    return v[int(np.floor(q * (len(v) - 1) + 0.5))]


def test_nearest_rank_matches_brute_force_with_hot_group(spark):
    rnd = random.Random(7)
    rows = [("hot", float(rnd.randint(0, 500))) for _ in range(3000)]
    rows += [(f"g{i % 40}", float(rnd.randint(0, 50))) for i in range(1500)]
    rows += [("one", 4.0), ("nulls", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.q for r in group_quantile_nearest(df, "g", "v", 0.95, "q").collect()}
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, vals in groups.items():
        assert got[g] == _brute_nearest(vals, 0.95), g


def test_ordered_cumulative_matches_pandas(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "b", None]), float(i), rnd.randint(1, 5)) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, o double, w long")
    got = {(r.k, r.o): (r._cum_before, r._cum) for r in ordered_cumulative(df, ["k"], "o", "w", 5).collect()}
    acc = {}
    for k, o, w in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        before = acc.get(k, 0)
        assert got[(k, o)] == (before, before + w)
        acc[k] = before + w


def test_global_cumulative(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("o"), F.lit(2).cast("long").alias("w"))
    got = sorted((r.o, r._cum) for r in ordered_cumulative(df, [], "o", "w", 6).collect())
    assert [c for _, c in got] == [2 * (i + 1) for i in range(100)]


def test_exact_median_matches_spark_percentile_with_hot_group(spark):
    from cardlens.operators.quantiles import group_median_exact

    rnd = random.Random(11)
    rows = [("hot", float(rnd.randint(0, 300))) for _ in range(2001)]
    rows += [(f"g{i % 30}", float(rnd.randint(-20, 20))) for i in range(900)]
    rows += [("pair", 1.0), ("pair", 4.0), ("single", 7.0), ("nulls", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.m for r in group_median_exact(df, "g", "v", "m").collect()}
    want = {r.g: r.m for r in df.groupBy("g").agg(F.median("v").alias("m")).collect() if r.m is not None}
    assert got == want
    assert got["pair"] == 2.5 and got["single"] == 7.0 and "nulls" not in got


def test_nearest_rank_composite_key_matches_brute_force(spark):
    rnd = random.Random(11)
    rows = [("hot", i % 2, float(rnd.randint(0, 300))) for i in range(2500)]
    rows += [(f"c{i % 30}", i % 2, float(rnd.randint(0, 40))) for i in range(900)]
    rows += [("solo", 1, 3.5), ("solo", 0, float("nan"))]
    df = spark.createDataFrame(rows, "c string, s int, v double")
    groups = {}
    for c, s, v in rows:
        if v == v:
            groups.setdefault((c, s), []).append(v)
    got = {(r.c, r.s): r.q for r in group_quantile_nearest(df, ["c", "s"], "v", 0.95, "q").collect()}
    assert got == {k: _brute_nearest(v, 0.95) for k, v in groups.items()}
