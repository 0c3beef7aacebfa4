"""Plan-shape properties: size-checked broadcast and its fallback, no
cartesian products, pruned scans."""

import re

import pytest
from pyspark.sql import functions as F

from cardlens.operators.joins import checked_broadcast, join_dimension
from cardlens.plans.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_dimension_is_broadcast_large_is_shuffled(spark):
    fact = spark.range(1000).select((F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    dim = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    _, small = checked_broadcast(dim)
    _, big = checked_broadcast(dim, max_bytes=1)
    assert small and not big
    a = sorted(tuple(r) for r in join_dimension(fact, dim, "k").collect())
    b = sorted(tuple(r) for r in join_dimension(fact, dim, "k", max_bytes=1).collect())
    assert a == b and len(a) == 1000


@pytest.mark.parametrize("name", sorted(n for n in ORACLE if n not in ("card_features_volume",)))
def test_no_cartesian_or_nested_loop_join(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_flagship_scan_is_pruned_and_filtered(spark):
    from cardlens.plans.queries import prepared

    p = prepared(spark, SF).select("card_number", "transaction_amount_kzt")
    text = p._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(user_id), IsNotNull(value)" in text
    # the events scan reads only what card/amount/merchant key need
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double,props:string>" in text


def test_card_features_multiply_no_rows(spark):
    from cardlens.operators.features import build_card_level_features
    from cardlens.plans.queries import prepared

    plan = _plan(build_card_level_features(prepared(spark, SF)))
    # no Expand, no range shuffle, no percentile maps; a codegen wide pass
    assert "Expand" not in plan and "rangepartitioning" not in plan and "percentile" not in plan
    assert "HashAggregate(keys=[card_number" in plan


def test_large_cards_are_counted_from_distinct_rows(spark):
    """Sets are gathered for small cards only; both ways give the same counts."""
    from cardlens.operators.features import DISTINCT_FEATURES, distinct_counts
    from cardlens.plans.queries import prepared

    txn = prepared(spark, SF)
    names = list(DISTINCT_FEATURES)
    rows = [sorted(map(tuple, distinct_counts(txn, names, w).collect())) for w in (0, 5, 10**6)]
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) > 10
    hot = _plan(distinct_counts(txn, names, 0))
    assert "left_semi" in hot.lower() or "leftsemi" in hot.lower()


def test_safe_encoding_joins_weights_once(spark):
    df = QUERIES["encode_train_apply"](spark, SF)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 2  # the weights, and the q95 of each card


def test_dimension_join_of_null_keys(spark):
    fact = spark.range(1000).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 50).alias("k"), F.col("id").alias("v")
    )
    dim = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    a = sorted(map(repr, join_dimension(fact, dim, "k").collect()))
    b = sorted(map(repr, join_dimension(fact, dim, "k", max_bytes=1).collect()))
    assert a == b and len(a) == 1000
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().isEmpty()


def test_features_sink_is_in_card_order(spark, tmp_path):
    from cardlens.sources.sinks import write_features

    df = spark.range(500).select((F.col("id") * 7919 % 500).cast("string").alias("card_number")).repartition(6)
    write_features(df, str(tmp_path / "f"))
    parts = sorted((tmp_path / "f").glob("part-*.parquet"))
    cards = [r.card_number for p in parts for r in spark.read.parquet(str(p)).collect()]
    assert cards == sorted(cards) and len(cards) == 500


def _method_sizes(df) -> list[int]:
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]


def test_generated_methods_are_compiled(spark):
    """The JVM interprets methods of 8,000 bytes and more: the fused cleaning stages stay below."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else stages are fused only when they run
    try:
        for name in ("parse_dates", "parse_timestamps", "parse_bool_flags", "normalize_txn", "txn_enriched"):
            sizes = _method_sizes(QUERIES[name](spark, SF))
            assert sizes and max(sizes) < 8000, (name, sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_labels_alone_need_no_features(spark):
    plan = _plan(QUERIES["split_stratified"](spark, SF))
    assert "Expand" not in plan and "props" not in plan and "Join" not in plan
