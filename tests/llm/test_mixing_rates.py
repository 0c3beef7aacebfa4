"""Mixing keeps clean text: rare cells, little noise, single marks, margins met as run."""

import warnings

import numpy as np
import pytest
from brute_mixing import mix
from pyspark.sql import functions as F

from cardlens.llm import mixing

SF = "/root/testdata/sf0.01/documents.parquet"


def shares(docs):
    """Expected kept share of all tokens (null) and of each topic."""
    rows = mixing.calibrate(docs, mixing.margins_of(docs), ceilings=mixing.TARGETS)
    kept = F.sum(F.col("_mix_tokens") * F.col("_mix_probability")) / F.sum("_mix_tokens")
    return {r[0]: r[1] for r in rows.rollup("_mix_topic").agg(kept).collect()}


def one(docs, i, text, lang, source):
    cols = {"doc_id": i, "text": text, "lang": lang, "source": source}
    return docs.limit(1).select(*(F.lit(cols[c]).cast(t).alias(c) if c in cols else F.lit(0).cast(t).alias(c) for c, t in docs.dtypes))


@pytest.mark.parametrize("lang", ["en", "a new one"])
def test_a_document_of_a_new_source_lowers_no_rate(spark, lang):
    docs = spark.read.parquet(SF)
    got = shares(docs.unionByName(one(docs, 10**9, "five words are in here", lang, "tiny")))
    assert got[None] >= mixing.BUDGET - 1e-6
    assert got["prose"] > got["noisy"]


def test_little_noise_is_not_lifted(spark):
    docs = spark.read.parquet(SF)
    noisy = mixing.topic(F.col("text")) == "noisy"
    few = docs.filter(~noisy | (F.pmod(F.xxhash64("doc_id"), F.lit(20)) == 0))
    got = shares(few)
    assert got[None] >= mixing.BUDGET - 1e-6 and got["prose"] >= 0.7 and got["noisy"] <= 1.1 * got["prose"]


def test_one_pair_of_symbols_is_no_noise(spark):
    text = "if (a && b) return; " + "plain words go on here " * 40
    rows = [(text,), ("$$$ %%% &&& ### " * 20,), ("**",), ("",), (None,)]
    found = spark.createDataFrame(rows, "t string").select(mixing.topic(F.col("t"))).collect()
    assert [r[0] for r in found] == ["prose", "noisy", "noisy", "prose", "prose"]


def cells(spark, rows):
    return spark.createDataFrame(rows, "a string, b string, _mix_tokens long")


def test_production_rounds_meet_the_margins(spark):
    rows = [("s", "prose", 900), ("s", "noisy", 60), ("t", "prose", 500), ("junk", "noisy", 40), ("junk", "prose", 1)]
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        out = mixing.rake(cells(spark, rows), ["a", "b"], ceilings={"b": {"noisy": 0.02}}).collect()
    kept = {(r.a, r.b): r["_mix_tokens"] * r["_mix_probability"] for r in out}
    total = sum(kept.values())
    want = {a: (sum(n for x, _, n in rows if x == a) / 1501) ** mixing.TEMPER for a in ("s", "t", "junk")}
    for a, w in want.items():
        assert sum(v for k, v in kept.items() if k[0] == a) / total == pytest.approx(w / sum(want.values()), abs=mixing.TOLERANCE)


def test_margins_that_cannot_be_met_are_reported(spark):
    rows = [("s", "x", 900), ("t", "y", 100)]
    with pytest.warns(RuntimeWarning, match="margins not met"):
        mixing.rake(cells(spark, rows), ["a", "b"], {"a": {"t": 0.3}, "b": {"y": 0.1}}).collect()


def test_budget_is_met_exactly_with_probabilities_at_most_1(spark):
    rows = [("s", "x", 90_000), ("t", "x", 9_000), ("u", "x", 90), ("v", "x", 1)]
    out = mixing.rake(cells(spark, rows), ["a"], temper=0.5, budget=0.9).collect()
    kept = sum(r["_mix_tokens"] * r["_mix_probability"] for r in out)
    assert kept / 99_091 == pytest.approx(0.9, abs=1e-6)
    assert all(0 < r["_mix_probability"] <= 1 for r in out)


def test_rounds_go_on_while_they_help():
    """2,000 random cell tables: wherever 1,000 plain rounds meet the margins, the stop rule does too."""
    rng = np.random.default_rng(5)
    met = slow = 0
    for _ in range(2000):
        shape = rng.integers(2, 6, 3)
        table = np.exp(rng.normal(0, 2.5, shape)) * (rng.random(shape) < 0.5)
        if not table.sum():
            continue
        w, wants = table / table.sum(), []
        for a in range(3):
            share = w.sum(axis=tuple(b for b in range(3) if b != a))
            want = np.where(share > 0, share**mixing.TEMPER, 0)
            wants.append(want / want.sum())
        errors, stopped = [], None
        for look in range(mixing.MOST_ROUNDS // mixing.ROUNDS):
            for _ in range(mixing.ROUNDS):
                for a in range(3):
                    now = w.sum(axis=tuple(b for b in range(3) if b != a))
                    w = w * np.divide(wants[a], now, out=np.zeros_like(now), where=now > 0).reshape([-1 if b == a else 1 for b in range(3)])
            errors.append(max(np.abs(w.sum(axis=tuple(b for b in range(3) if b != a)) - wants[a]).max() for a in range(3)))
            if stopped is None and mixing.finished(errors):
                stopped = look
            if errors[-1] <= mixing.TOLERANCE or (len(errors) > 30 and errors[-1] > 0.9999 * errors[-25]):
                break
        if errors[-1] <= mixing.TOLERANCE:
            met += 1
            slow += look > 0
            assert stopped == look, errors
    assert met > 1000 and slow > 50


def test_query_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    rows += [dict(rows[0], doc_id=None), dict(rows[1], text=None, source=None), dict(rows[2], doc_id=-5, text="")]
    frame = spark.createDataFrame([tuple(r.values()) for r in rows], docs.schema)
    report = []
    out = mixing.calibrate(frame, mixing.margins_of(frame), ceilings=mixing.TARGETS, report=report).select(
        "doc_id", "_mix_probability", mixing.sampled().alias("kept")
    )
    got = sorted(((str(r.doc_id), r["_mix_probability"], r.kept) for r in out.collect()), key=lambda r: (r[0], r[1]))
    want = sorted(((str(r["doc_id"]), p, k) for r, p, k in mix(rows)), key=lambda r: (r[0], r[1]))
    assert [(i, k) for i, _, k in got] == [(i, k) for i, _, k in want]
    assert all(a == pytest.approx(b, abs=2e-3) for (_, a, _), (_, b, _) in zip(got, want, strict=True))
    reached = report[0].collect()
    assert {r.margin for r in reached} == {"source", "lang", "topic"}
    for m in ("source", "lang", "topic"):
        assert sum(r.raked for r in reached if r.margin == m) == pytest.approx(1)


def test_cells_past_the_broadcast_bound_and_reserved_names(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    one = sorted(map(tuple, mixing.calibrate(docs, mixing.margins_of(docs)).select("doc_id", "_mix_probability").collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        two = sorted(map(tuple, mixing.calibrate(docs, mixing.margins_of(docs)).select("doc_id", "_mix_probability").collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold") if limit is None else spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert one == two
    with pytest.raises(ValueError, match="reserved"):
        mixing.calibrate(docs.withColumn("_mix_x", F.lit(1)), mixing.margins_of(docs))
