"""Card features from daily states against the full computation."""

import datetime
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from cardlens.config import CARD_ID_COLUMN
from cardlens.operators import features, state
from cardlens.operators.materialize import scratch_path

SCHEMA = (
    "card_number string, label tinyint, transaction_amount_kzt double, merchant_id string, mcc string, country string, "
    "merchant_country string, channel string, tokenized boolean, Is_recurring boolean, recurring_capable boolean, "
    "transaction_date date, transaction_datetime timestamp_ntz"
)
DAYS = [datetime.date(2024, 2, d) for d in range(1, 9)]


def _rows(n=2500, seed=5):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        day = rnd.choice([*DAYS, None])
        time = None if day is None else datetime.datetime.combine(day, datetime.time(rnd.randint(0, 23), 15))
        card = "hot" if i % 3 == 0 else f"c{rnd.randint(0, 40)}"
        amount = rnd.choice([None, -0.0, 0.0, 150.25, 1e9 + 0.25, 7000.0]) if i % 2 else rnd.uniform(-5, 1e5)
        if card == "c7":
            amount = None
        if card == "c8" and i % 5 == 0:
            amount = float("nan")
        text = [rnd.choice([None, "", "a", "b", str(rnd.randint(0, 90))]) for _ in range(4)]
        flags = [rnd.choice([None, True, False]) for _ in range(3)]
        out.append((card, rnd.randint(0, 1), amount, *text, rnd.choice([None, "online", "offline"]), *flags, day, time))
    out.append(("single", 1, 5.0, "m", "1", "KZ", "KZ", "online", True, True, True, DAYS[0], None))
    return out


def _same(got, want):
    assert [f.name for f in got.schema] == [f.name for f in want.schema]
    got = {r[CARD_ID_COLUMN]: r.asDict() for r in got.collect()}
    want = {r[CARD_ID_COLUMN]: r.asDict() for r in want.collect()}
    assert got.keys() == want.keys()
    for card, row in want.items():
        for name, x in row.items():
            y = got[card][name]
            if isinstance(x, float) and isinstance(y, float):
                assert (math.isnan(x) and math.isnan(y)) or math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9), (card, name, x, y)
            else:
                assert x == y, (card, name, x, y)


def _files(path):
    return {os.path.join(d, f) for d, _, fs in os.walk(path.removeprefix("file:")) for f in fs if f.endswith(".parquet")}


def _of(files, day):
    return {f for f in files if f"{state.DAY}={day}/" in f}


def test_late_day_equals_full_run_and_touches_only_its_partition(spark):
    rows = _rows()
    late = DAYS[3]
    source = scratch_path(spark, "dated-source")
    full = spark.createDataFrame(rows, SCHEMA)
    full.filter((F.col("transaction_date") != late) | F.col("transaction_date").isNull()).write.partitionBy(
        "transaction_date"
    ).parquet(source)
    path = scratch_path(spark, "states")
    state.update_states(spark.read.parquet(source), path)
    before = _files(path)
    _same(state.merge_features(spark, path), features.build_card_level_features(spark.read.parquet(source)))

    full.filter(F.col("transaction_date") == late).write.mode("append").partitionBy("transaction_date").parquet(source)
    txn = spark.read.parquet(source)
    state.update_states(txn, path, [late])
    after = _files(path)
    assert before <= after
    assert _of(after - before, late) == after - before != set()
    _same(state.merge_features(spark, path), features.build_card_level_features(txn))

    # the update reads one partition of the source
    plan = state.daily_totals(state._chosen(txn, [late]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(transaction_date" in plan or "PartitionFilters: [transaction_date" in plan

    # a second run of the same day changes nothing
    state.update_states(txn, path, [late])
    _same(state.merge_features(spark, path), features.build_card_level_features(txn))

    # undated transactions are a day too; a dropped day is gone
    state.update_states(txn, path, [None, DAYS[0]])
    _same(state.merge_features(spark, path), features.build_card_level_features(txn))
    state.drop_days(spark, path, [late, None])
    rest = txn.filter(F.col("transaction_date") != late)
    _same(state.merge_features(spark, path), features.build_card_level_features(rest))


def test_corrected_day_replaces_its_rows(spark):
    rows = _rows(400, 9)
    path = scratch_path(spark, "states")
    state.update_states(spark.createDataFrame(rows, SCHEMA), path)
    corrected = [r for i, r in enumerate(rows) if r[-2] != DAYS[1] or i % 2]
    txn = spark.createDataFrame(corrected, SCHEMA)
    state.update_states(txn, path, [DAYS[1]])
    _same(state.merge_features(spark, path), features.build_card_level_features(txn))


def test_empty_source(spark):
    path = scratch_path(spark, "states")
    empty = spark.createDataFrame([], SCHEMA)
    state.update_states(spark.createDataFrame(_rows(50), SCHEMA), path)
    state.update_states(empty, path)  # no day, so nothing is replaced
    assert state.merge_features(spark, path).count() > 0
    assert state.merge_totals(state.daily_totals(empty)).count() == 0
    assert state.merge_distinct(state.daily_values(empty)).count() == 0
    assert state.merge_median(state.daily_amounts(empty)).count() == 0


@pytest.mark.parametrize(("window_rows", "digits"), [(10, 16), (10**6, 64)])
def test_median_from_counted_amounts(spark, window_rows, digits):
    """Bounded windows and narrowing take the number of times an amount was seen into account."""
    txn = spark.createDataFrame(_rows(), SCHEMA)
    got = state.merge_median(state.daily_amounts(txn), window_rows=window_rows, digits=digits)
    values = {}
    for r in _rows():
        if r[2] is not None:
            values.setdefault(r[0], []).append(r[2])
    want = {}
    for card, v in values.items():
        v.sort(key=lambda x: (math.isnan(x), x if not math.isnan(x) else 0.0))
        want[card] = v[(len(v) - 1) // 2] * 0.5 + v[len(v) // 2] * 0.5
    assert repr(sorted((c, x + 0.0) for c, x in got.collect())) == repr(sorted((c, x + 0.0) for c, x in want.items()))


def test_merged_sketches_keep_their_error_bound(spark):
    """20,000 merchants and amounts of a card, spread over the days, a third of the rows twice."""
    n = 30_000
    base = spark.range(n).select(
        F.lit("big").alias("card_number"),
        (F.col("id") % 20_000).cast("double").alias("transaction_amount_kzt"),
        (F.col("id") % 20_000).cast("string").alias("merchant_id"),
        F.lit(None).cast("string").alias("country"),
        F.date_add(F.lit(DAYS[0]), (F.col("id") % 8).cast("int")).alias("transaction_date"),
    )
    missing = [c for c in spark.createDataFrame([], SCHEMA).schema if c.name not in base.columns]
    txn = base.withColumns({c.name: F.lit(None).cast(c.dataType) for c in missing})
    path = scratch_path(spark, "sketches")
    state.update_sketches(txn.filter("day(transaction_date) < 4"), path)
    state.update_sketches(txn, path, DAYS[3:])
    sketches = state.read_state(spark, path, "sketches")
    assert sketches.count() == 8
    row = state.merge_sketches(sketches, {"median": 0.5, "q95": 0.95}).collect()[0]
    assert row.total_transactions == n and row.active_days == 8 and row.unique_countries == 0
    assert abs(row.unique_merchants - 20_000) <= 0.08 * 20_000
    amounts = sorted(float(i % 20_000) for i in range(n))
    for got, rank in ((row.median, 0.5), (row.q95, 0.95)):
        assert sum(a < got for a in amounts) / n <= rank + 0.05
        assert sum(a <= got for a in amounts) / n >= rank - 0.05
    nothing = txn.limit(10).withColumn("transaction_amount_kzt", F.lit(None).cast("double"))
    assert state.merge_sketches(state.daily_sketches(nothing), {"median": 0.5}).collect()[0].median is None
