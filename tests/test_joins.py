"""The join beyond broadcast: hot keys are spread, results are those of a plain join."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from cardlens.operators.joins import hot_keys, join_dimension, salted_left_join

COLUMNS = "merchant string, amount double, tags array<string>"


def _rows(n=6000):
    """60 % on one merchant, a tenth without one, repeated rows, unknown merchants."""
    out = []
    for i in range(n):
        merchant = "hot" if i % 10 < 6 else None if i % 10 == 6 else f"m{i % 83}"
        out.append((merchant, float(i % 500), ["x"] if i % 2 else None))
    return out


@pytest.fixture(scope="module")
def fact(spark):
    return spark.createDataFrame(_rows(), COLUMNS).repartition(6)


@pytest.fixture(scope="module")
def dim(spark):
    rows = [("hot", "KZ"), ("hot", "second"), ("unused", "US"), (None, "none"), *((f"m{k}", f"c{k % 5}") for k in range(40))]
    return spark.createDataFrame(rows, "merchant string, country string")


def _counted(df):
    return Counter((r.merchant, r.amount, tuple(r.tags or ()), r.country) for r in df.collect())


@pytest.mark.parametrize("hot_rows", [1, 50, 10**6])
def test_equals_plain_join(fact, dim, hot_rows):
    got = salted_left_join(fact, dim, "merchant", hot_rows)
    want = fact.join(dim, "merchant", "left")
    assert got.columns == want.columns
    assert _counted(got) == _counted(want)
    assert _counted(join_dimension(fact, dim, "merchant", max_bytes=1)) == _counted(want)


def test_hot_keys_are_counted(fact):
    assert [(r._hot, r._salts) for r in hot_keys(fact, "merchant", 500).collect()] == [("hot", 8)]
    assert hot_keys(fact.filter("merchant = 'hot'").limit(10), "merchant", 11).collect() == []
    assert hot_keys(fact.limit(0), "merchant").collect() == []


def test_no_task_above_twice_the_median(spark, fact, dim):
    dim = dim.filter("country != 'second'")
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:

        def sizes(df):
            keyed = df.filter("merchant IS NOT NULL").groupBy(F.spark_partition_id().alias("p")).count()
            return sorted(r["count"] for r in keyed.collect())

        plain, salted = sizes(fact.join(dim, "merchant", "left")), sizes(salted_left_join(fact, dim, "merchant", 40))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert plain[-1] > 4 * plain[len(plain) // 2]
    assert salted[-1] <= 2 * salted[len(salted) // 2]


def test_empty_sides(fact, dim):
    assert salted_left_join(fact.limit(0), dim, "merchant", 1).collect() == []
    assert salted_left_join(fact, dim.limit(0), "merchant", 100).filter("country IS NULL").count() == 6000
