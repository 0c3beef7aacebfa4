"""Approximate nearest neighbours by inner product over shifted Hilbert curves.

1. ``fit`` learns from a bounded sample of rows (``SAMPLE``, those with the least hash): a seeded rotation,
   scales, a shift per curve, and block borders, quantiles of the sample's Hilbert keys. Vectors
   get one more coordinate that makes all as long as the longest; then the largest inner
   product is the smallest distance, and queries are scaled to that length too.
2. Every row is filed, per curve, under the block of its key: ranges of the key, dealt out as
   ``(curve, block, part)``. Blocks of more than ``BLOCK_ROWS`` rows (counted over all rows) are split
   into parts by a hash of the row, so a block of copies of one vector never is one task.
3. A query goes to the blocks within ``window`` of its own on every curve and to all their parts. Every part gives its
   ``k`` best by exact inner product in double precision; these lists are merged and ranked.
4. ``window`` is measured, not set: at most ``PROBES`` queries are compared with all rows, and the least
   window that holds ``TARGET`` of their true neighbours on some curve is taken for all queries. Where
   vectors have structure it is a small share of the blocks; uniformly random vectors in many
   dimensions have none that a curve could use, and the window grows to most of the blocks.

No row is capped or dropped: borders come from a sample, all rows are filed and counted. What
the driver holds is bounded: sample, borders and one count per block and curve (``MOST_BLOCKS``).

Defined cases: vectors that are null, empty, zero, hold a null or non-finite component, or whose
length is not the most frequent (least of equals) take no part; a null id is a candidate, never a query; a
query's own id is never its neighbour; rows that repeat an id count once, by the best of their
vectors; ties go to the smaller id, a null id last; fewer candidates than ``k`` give them all; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CURVES, AXES, BITS = 4, 8, 7  # keys of AXES * BITS bits
SAMPLE = 16_384  # rows that scales and borders are learned from
PROBES, TARGET = 64, 0.96  # queries compared with all rows; share of their neighbours to be found
BLOCK_ROWS, MOST_BLOCKS = 8192, 4096
QUERY_ROWS = 32_768  # queries of a part that are dealt out together
SEED = 20_11
NEAR = 1e-9  # products closer than this, for the longest vectors, are compared in a fixed order of sums


class Curves(NamedTuple):
    """All that files a vector: plain arrays, as large as dimensions and ``MOST_BLOCKS`` allow."""

    longest: float
    axes: np.ndarray  # (curves, dimensions + 1, axes)
    low: np.ndarray  # (curves, axes)
    width: np.ndarray
    shift: np.ndarray
    borders: list[np.ndarray]  # first key of each block after the first

    def blocks(self, vectors: np.ndarray, as_query: bool) -> np.ndarray:
        """Block of each vector on each curve, ``(curves, vectors)``."""
        return np.stack([np.searchsorted(b, k, "right") for b, k in zip(self.borders, self.keys(vectors, as_query), strict=True)])

    def keys(self, vectors: np.ndarray, as_query: bool) -> list[np.ndarray]:
        norms = np.sqrt((vectors * vectors).sum(axis=1))
        if as_query:
            more, vectors = np.zeros(len(vectors)), vectors * (self.longest / norms)[:, None]
        else:
            more = np.sqrt(np.maximum(self.longest**2 - norms**2, 0))
        full = np.column_stack([vectors, more])
        out = []
        for c in range(len(self.axes)):
            at = (full @ self.axes[c] - self.low[c]) / self.width[c] * (2 / 3) + self.shift[c]
            cells = np.clip(at * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
            out.append(hilbert_keys(cells, BITS))
        return out


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of integer cells ``(n, axes)`` along a Hilbert curve through the cube of side ``2**bits``:
    from the top bit down, each axis's bit tells how the smaller cube is mirrored or turned."""
    x = [cells[:, a].copy() for a in range(cells.shape[1])]
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for a in range(len(x)):
            mirrored = (x[a] >> bit) & 1 == 1
            turn = np.where(mirrored, 0, (x[0] ^ x[a]) & low)
            x[0] ^= np.where(mirrored, low, turn)
            x[a] ^= turn
    for a in range(1, len(x)):  # Gray code across the axes
        x[a] ^= x[a - 1]
    flip = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << 1) | (((axis ^ flip) >> bit) & 1)
    return key


# -- vectors ------------------------------------------------------------------------
def usable(vector: Column) -> Column:
    v = vector.cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def vectors_of(rows: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """``id, vector`` of the rows that take part, and their dimension (0: none)."""
    vector = rows[vector_col]
    if rows.schema[vector_col].dataType.simpleString() != "array<float>":
        vector = vector.cast("array<double>")
    rows = rows.select(rows[id_col].alias("id"), F.when(usable(vector), vector).alias("vector")).filter("vector IS NOT NULL")
    sizes = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"))
    most = sizes.orderBy(F.desc("n"), "size").first()
    size = most["size"] if most else 0
    return rows.filter(F.size("vector") == size), size


def matrix(column: pa.Array, size: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _least(rows: DataFrame, salt: str, most: int) -> pa.Table:
    """At most ``most`` rows, those with the least hash."""
    return rows.orderBy(F.xxhash64("id", "vector", F.lit(salt)), "id").limit(most).toArrow()


def fit(rows: DataFrame, size: int, curves: int = CURVES, sample: int = SAMPLE, block_rows: int = BLOCK_ROWS) -> Curves:
    """Curves for the rows of ``vectors_of``."""
    square = F.aggregate(F.col("vector").cast("array<double>"), F.lit(0.0), lambda a, x: a + x * x)
    total, longest = rows.agg(F.count("*"), F.max(square)).first()
    longest = float(longest) ** 0.5 * (1 + 1e-12)
    seen = matrix(_least(rows.select("id", "vector"), "fit", sample)["vector"], size)
    rng = np.random.default_rng(SEED)
    axes = min(AXES, size + 1)
    turns = []
    while sum(t.shape[1] for t in turns) < curves * axes:  # rotations, until there are axes enough
        turns.append(np.linalg.qr(rng.normal(size=(size + 1, size + 1)))[0])
    every = np.hstack(turns)[:, : curves * axes].reshape(size + 1, curves, axes).transpose(1, 0, 2)
    more = np.sqrt(np.maximum(longest**2 - (seen * seen).sum(axis=1), 0))
    at = np.stack([np.column_stack([seen, more]) @ a for a in every])
    low, high = np.quantile(at, 0.005, axis=1), np.quantile(at, 0.995, axis=1)
    width = np.maximum(high - low, 1e-12 * longest)
    found = Curves(longest, every, low, width, rng.random((curves, axes)) / 3, [])
    blocks = int(min(MOST_BLOCKS, max(1, -(-total // block_rows))))
    for keys in found.keys(seen, False):
        keys.sort()
        places = np.arange(1, blocks) * len(keys) // blocks
        found.borders.append(np.unique(keys[places]))
    return found


# -- the window --------------------------------------------------------------------
def best_of(products: np.ndarray, ids: np.ndarray, nulls: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best, least id first among equals, each id once."""
    order = np.lexsort((np.unique(ids, return_inverse=True)[1], nulls, -products))
    seen, best = set(), []
    for p in order.tolist():
        key = None if nulls[p] else ids[p]
        if key not in seen:
            seen.add(key)
            best.append(p)
            if len(best) == k:
                break
    return np.array(best, np.int64)


def exact_products(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products whose sums are taken in one order for every vector: equal vectors tie."""
    return (vectors * query).sum(axis=1)


def top_products(
    queries: np.ndarray, own: np.ndarray, vectors: np.ndarray, ids: np.ndarray, nulls: np.ndarray, k: int, near: float
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query its number, the places of its ``k`` best and their exact products."""
    step = max(1, (4 << 20) // max(1, len(vectors)))
    for at in range(0, len(queries), step):
        some = queries[at : at + step] @ vectors.T
        for j, row in enumerate(some, at):
            other = nulls | (ids != own[j])
            left = int(other.sum())
            if not left:
                continue
            row = np.where(other, row, -np.inf)
            wanted = min(k, left)
            while True:
                cut = np.partition(row, len(row) - wanted)[len(row) - wanted]
                places = np.flatnonzero((row >= cut - near) & other)
                exact = exact_products(queries[j], vectors[places])
                best = best_of(exact, ids[places], nulls[places], k)
                if len(best) >= k or len(places) >= left:
                    break
                wanted = min(2 * wanted, left)  # repeated ids: look further
            yield j, places[best], exact[best]


def measured_window(rows: DataFrame, queries: DataFrame, size: int, curves: Curves, k: int, target: float, probes: int = PROBES) -> int:
    """Least distance in blocks that holds ``target`` of the true neighbours of some queries."""
    table = _least(queries, "probe", probes)
    if not table.num_rows:
        return 0
    asked, own = matrix(table["vector"], size), np.array(table["id"].to_pylist())
    at, near = curves.blocks(asked, True), NEAR * curves.longest**2

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix(batch.column(1), size)
            nulls, ids = _ids(batch.column(0))
            away = np.abs(curves.blocks(vectors, False)[:, None, :] - at[:, :, None]).min(axis=0)
            out = [
                {"probe": j, "score": float(s), "away": int(away[j, p])}
                for j, places, scores in top_products(asked, own, vectors, ids, nulls, k, near)
                for p, s in zip(places, scores, strict=True)
            ]
            schema = pa.schema([("probe", pa.int32()), ("score", pa.float64()), ("away", pa.int32())])
            yield from pa.Table.from_pylist(out, schema).to_batches()

    found = rows.select("id", "vector").mapInArrow(search, "probe int, score double, away int")
    order = Window.partitionBy("probe").orderBy(F.desc("score"), "away")
    found = found.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k)
    away = np.sort([r.away for r in found.select("away").collect()])  # PROBES * k at most
    return int(away[min(len(away) - 1, int(np.ceil(target * len(away))))]) if len(away) else 0


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which ids are null, and ids with null ones replaced by some value."""
    nulls = column.is_null().to_numpy(zero_copy_only=False)
    filler = "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else 0
    return nulls, column.fill_null(filler).to_numpy(zero_copy_only=False)


def _arrow_type(id_type: str) -> pa.DataType:
    known = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    if id_type not in known:
        raise ValueError(f"ids of type {id_type}: cast them to bigint, int or string")
    return known[id_type]


def _unpacked(column: pa.ChunkedArray, dtype: str, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).astype(np.float64).reshape(-1, size)


# -- the search --------------------------------------------------------------------
def _filed(rows: DataFrame, size: int, curves: Curves, as_query: bool) -> DataFrame:
    """``id, vector`` and ``blocks``, one per curve; vectors as bytes."""
    id_type = rows.schema["id"].dataType.simpleString()

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix(batch.column(1), size)
            blocks = curves.blocks(vectors, as_query).T.astype(np.int32)
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            parts = flat.reshape(-1, size)
            packed = pa.array([p.tobytes() for p in parts], pa.binary())
            listed = pa.ListArray.from_arrays(np.arange(0, blocks.size + 1, blocks.shape[1], dtype=np.int32), blocks.ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0), packed, listed], ["id", "vector", "blocks"])

    return rows.select("id", "vector").mapInArrow(file, f"id {id_type}, vector binary, blocks array<int>")


def _block_counts(filed: DataFrame, curves: Curves) -> list[np.ndarray]:
    """Rows per block of each curve: at most ``MOST_BLOCKS`` numbers a curve."""
    each = filed.select(F.posexplode("blocks").alias("curve", "block"))
    counts = [np.zeros(len(b) + 1, np.int64) for b in curves.borders]
    for curve, block, n in each.groupBy("curve", "block").agg(F.count("*").alias("n")).collect():
        counts[curve][block] = n
    return counts


def _table(values: list[np.ndarray]) -> Column:
    return F.array(*(F.array(*(F.lit(int(v)) for v in one)) for one in values))


def _dealt(spread: Column, parts: Column) -> Column:
    return F.pmod(spread, parts).cast("int")


def nearest(
    rows: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    target: float = TARGET,
    curves: int = CURVES,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
    window: int | None = None,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows of every row of ``rows`` for whose
    ``id`` the condition ``is_query`` holds. ``window`` is measured if not given."""
    rows, size = vectors_of(rows, id_col, vector_col)
    id_type = rows.schema["id"].dataType.simpleString()
    none = f"query_id {id_type}, rank int, vec_id {id_type}, score double"
    queries = rows.filter(F.coalesce(is_query, F.lit(False)) & F.col("id").isNotNull())
    if not size:
        return rows.sparkSession.createDataFrame([], none)
    fitted = fit(rows, size, curves, block_rows=block_rows)
    if window is None:
        window = measured_window(rows, queries, size, fitted, k, target)
    filed, asked = _filed(rows, size, fitted, False), _filed(queries, size, fitted, True)
    counts, asks = _block_counts(filed, fitted), _block_counts(asked, fitted)
    parts = [np.maximum(1, -(-c // block_rows)) for c in counts]
    # queries of a block are dealt out in slices, by the number that its window brings
    reach = [np.convolve(a, np.ones(2 * window + 1, np.int64))[window : window + len(a)] for a in asks]
    slices = [np.maximum(1, -(-r // query_rows)) for r in reach]
    parts_of, slices_of = _table(parts), _table(slices)

    def entry(table: Column) -> Column:
        return F.get(F.get(table, F.col("curve")), F.col("block"))

    to_parts = _dealt(F.xxhash64("id", "vector", F.lit("part")), entry(parts_of))
    left = filed.select("id", "vector", F.posexplode("blocks").alias("curve", "block"))
    left = left.select("*", to_parts.alias("part"), F.explode(F.sequence(F.lit(0), entry(slices_of) - 1)).alias("slice"))

    last = F.get(F.array(*(F.lit(len(c) - 1) for c in counts)), F.col("curve"))
    right = asked.select("id", "vector", F.posexplode("blocks").alias("curve", "own"))
    near_blocks = F.sequence(F.greatest(F.col("own") - window, F.lit(0)), F.least(F.col("own") + window, last))
    right = right.select("id", "vector", "curve", F.explode(near_blocks).alias("block"))
    to_slices = _dealt(F.xxhash64("id", "vector", F.lit("slice")), entry(slices_of))
    right = right.select("*", F.explode(F.sequence(F.lit(0), entry(parts_of) - 1)).alias("part"), to_slices.alias("slice"))

    dtype = "f4" if rows.schema["vector"].dataType.simpleString() == "array<float>" else "f8"
    near = NEAR * fitted.longest**2

    def search(rows: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows and asked.num_rows:
            vectors, wanted = (_unpacked(t["vector"], dtype, size) for t in (rows, asked))
            id_column = rows["id"].combine_chunks()
            nulls, ids = _ids(id_column)
            own_column = asked["id"].combine_chunks()
            for j, places, scores in top_products(wanted, _ids(own_column)[1], vectors, ids, nulls, k, near):
                own = own_column.take(pa.array(np.full(len(places), j)))
                out.append(pa.Table.from_arrays([own, id_column.take(pa.array(places)), pa.array(scores)], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    arrow_id = _arrow_type(id_type)
    schema = pa.schema([("query_id", arrow_id), ("vec_id", arrow_id), ("score", pa.float64())])
    key = ["curve", "block", "part", "slice"]
    pairs = left.groupBy(*key).cogroup(right.groupBy(*key))
    found = pairs.applyInArrow(search, f"query_id {id_type}, vec_id {id_type}, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
