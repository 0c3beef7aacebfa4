"""Nearest neighbours: recall and scores against brute force, exactness where the windows hold
everything, copies, ties and awkward vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardlens.llm import nearest
from cardlens.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, rank string, score string, id string, vector string"


def frame(spark, rows):
    data = [(i, None if v is None else [None if x is None else float(x) for x in v], 1, "r", "s", "i", "v") for i, v in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(4)


def brute(rows, k, is_query):
    """``query -> [(id, score)]``; null ids last among equals."""
    ok = [(i, np.array(v, np.float32).astype(np.float64)) for i, v in rows]
    out = {}
    for q, vec in ok:
        if q is None or not is_query(q):
            continue
        best = {}
        for i, v in ok:
            if i != q:
                s = float((v * vec).sum())
                best[i] = max(s, best.get(i, -np.inf))
        out.setdefault(q, []).extend(best.items())
    for q, found in out.items():
        best = {}
        for i, s in found:
            best[i] = max(s, best.get(i, -np.inf))
        out[q] = sorted(best.items(), key=lambda x: (-x[1], x[0] is None, x[0] or 0))[:k]
    return out


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for found in out.values():
        assert [n for n, *_ in found] == list(range(1, len(found) + 1))
    return {q: [x[1:] for x in found] for q, found in out.items()}


def recall(got, want):
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    return hits / sum(len(v) for v in want.values())


def test_hilbert_curve_is_one_path():
    for axes, bits in ((1, 3), (2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
        keys = nearest.hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        path = cells[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_all_blocks_in_reach_is_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6) * rng.uniform(0.2, 3)) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(60)]  # copies: ties go to the smaller id
    rows += [(None, rows[9][1]), rows[3], rows[3]]
    df = nearest.nearest(frame(spark, rows), F.col("id") % 5 == 0, 7, block_rows=40, query_rows=9, window=100)
    got, want = result(df), brute(rows, 7, lambda q: q % 5 == 0)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    for q, found in want.items():
        assert np.allclose([s for _, s in got[q]], [s for _, s in found], rtol=1e-12, atol=0)


def test_awkward_vectors(spark):
    rows = [(0, None), (1, []), (2, [0, 0]), (3, [1, None]), (4, [1, float("nan")]), (5, [float("inf"), 1]), (6, [1, 2, 3])]
    good = [(10, [1, 0]), (20, [0.5, 0.5]), (30, [-1, 0]), (31, [1, 0])]
    df = nearest.nearest(frame(spark, rows + good), F.col("id") % 10 == 0, 20)
    assert {q: [i for i, _ in v] for q, v in result(df).items()} == {10: [31, 20, 30], 20: [10, 31, 30], 30: [20, 10, 31]}
    assert nearest.nearest(frame(spark, rows[:3]), F.col("id") % 10 == 0).count() == 0
    assert nearest.nearest(frame(spark, rows).limit(0), F.col("id") % 10 == 0).count() == 0
    assert nearest.nearest(frame(spark, good[:1]), F.col("id") % 10 == 0).count() == 0


def test_other_types_and_a_hot_vector(spark):
    rows = [(f"k{i:03d}", [1.0, 2.0] if i % 3 else [float(i), 1.0]) for i in range(200)]
    df = spark.createDataFrame(rows, "key string, v array<double>")
    got = result(nearest.nearest(df, F.col("id").isin("k001", "k003"), 4, "key", "v", block_rows=16, query_rows=2))
    assert [i for i, _ in got["k001"]] == ["k198", "k195", "k192", "k189"]
    assert [i for i, _ in got["k003"]] == ["k198", "k195", "k192", "k189"]
    with pytest.raises(ValueError, match="cast"):
        nearest.nearest(df.selectExpr("cast(1 as double) key", "v"), F.col("id") == 1, 4, "key", "v").count()


def test_window_is_small_where_vectors_cluster(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 16)) * 3
    rows = [(i, centres[i % 40] + rng.normal(size=16) * 0.05) for i in range(2000)]
    vectors, size = nearest.vectors_of(frame(spark, rows), "vec_id", "embedding")
    queries = vectors.filter(F.col("id") % 20 == 0)
    fitted = nearest.fit(vectors, size, block_rows=50)
    window = nearest.measured_window(vectors, queries, size, fitted, 20, 0.96)
    # a fifth of the 40 blocks; random vectors need most of them
    assert window <= 8 and all(len(b) >= 30 for b in fitted.borders)
    df = nearest.nearest(frame(spark, rows), F.col("id") % 20 == 0, 20, block_rows=50)
    assert recall(result(df), brute(rows, 20, lambda q: q % 20 == 0)) >= 0.9


def test_registered_query_and_recall_on_many_blocks(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.select("vec_id", "embedding").collect()]
    want = brute(rows, 20, lambda q: q % 20 == 0)
    got = result(nearest.nearest(table, F.col("id") % 20 == 0, 20, block_rows=50))
    assert recall(got, want) >= 0.9
    small = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    got, want = result(QUERIES["op11_nearest"](spark, SMALL)), brute(small, 20, lambda q: q % 20 == 0)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
