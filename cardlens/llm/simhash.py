"""SimHash near-duplicates through pivot distance tables.

1. *Fingerprints* (Arrow batches, numpy inside): XXH64 of every word shingle,
   bit majority over all of them. Equal fingerprints become one node.
2. *Pivot table*: the Hamming distance of each node to 64 reference
   fingerprints. The references are Walsh rows, 16 for each quarter of the
   bits, so a quarter's 16 distances (less the distance to the zero
   fingerprint) fix that quarter's bits.
3. *Candidates*: two nodes within ``max_bits`` <= 2 bits agree on the distances of at
   least two quarters, so each node is filed under its six pairs of quarters.
   Within a block of at most ``BLOCK`` nodes, pairs whose largest coordinate
   difference exceeds ``max_bits`` are discarded (the triangle inequality says
   they cannot be near) and survivors are verified by their distance.
4. *Crowded blocks*: nodes of larger blocks meet at the fingerprints one bit
   away from them. All (at most 65) nodes within one bit of the same centre are
   within two bits of each other, and two nodes two bits apart share a centre:
   exact, and no group is larger than 65.
5. Links -> connected components of nodes -> smallest document id.

Defined cases: null or empty texts (and texts of white space) have
fingerprint 0, which links like any other; a text of fewer words than a
shingle is one shingle; repeated rows each give a row; a null id counts as no
id (a component of null ids only has a null id); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.llm.components import components
from cardlens.llm.scratch import cut
from cardlens.operators.joins import checked_broadcast

SEED = 42  # of the shingle hash
BLOCK = 64  # most nodes of a block that are compared pair by pair
COPIES = 64  # rows of a fingerprint beyond which they are not joined by a shuffle
BITS, QUARTER = 64, 16
SLICE_HASHES = 1 << 20  # hashes unpacked to bits at a time: bounds a worker's memory


# -- fingerprints -----------------------------------------------------------
def shingle_hashes(text: bytes, size: int) -> list[int]:
    """XXH64 of each run of ``size`` words (A-Z lower-cased, ASCII space only)."""
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    starts, at = [], 0
    for w in words:
        starts.append(at)
        at += len(w) + 1
    n = max(1, len(words) - size + 1)
    ends = [s - 1 for s in starts[size:]] + [len(joined)]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts[:n], ends, strict=True)]


def majority(hashes: list[int]) -> int:
    """Bits set in over half of the hashes."""
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), SLICE_HASHES):
        some = np.array(hashes[k : k + SLICE_HASHES], ">u8")
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int.from_bytes(np.packbits(bits).tobytes(), "big", signed=True)


def fingerprints(
    docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, fp long`` (the 64 bits as a signed number) of every whole text."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            fps = [majority(shingle_hashes(t.as_py(), shingle)) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fps, pa.int64())], ["id", "fp"])

    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    return rows.mapInArrow(run, f"id {id_type}, fp long")


# -- pivots -----------------------------------------------------------------
def references() -> list[int]:
    """16 Walsh rows for each quarter of the 64 bits, zero elsewhere; the first
    row of a quarter sets all its bits."""
    out = []
    for quarter in range(BITS // QUARTER):
        for row in range(QUARTER):
            bits = sum(1 << b for b in range(QUARTER) if (row & b).bit_count() % 2 == 0)
            out.append(bits << quarter * QUARTER)
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pivot_distances(fp: Column) -> Column:
    """Hamming distances to all references, as an array of bytes."""
    return F.array(
        *(F.bit_count(fp.bitwiseXOR(F.lit(_signed(r)))).cast("tinyint") for r in references())
    )


def block_keys(fp: Column, pivots: Column) -> Column:
    """One key for each pair of quarters, of both quarters' distances (less
    that to the zero fingerprint, which leaves what the quarter alone gives)."""
    zero = F.bit_count(fp).cast("tinyint")
    part = [
        F.transform(F.slice(pivots, q * QUARTER + 1, QUARTER), lambda d: (d - zero).cast("tinyint"))
        for q in range(BITS // QUARTER)
    ]
    return F.array(
        *(
            F.xxhash64(F.lit(f"{a}{b}"), part[a], part[b])
            for a, b in combinations(range(len(part)), 2)
        )
    )


def _far_apart(a: Column, b: Column, most: int) -> Column:
    return F.exists(F.zip_with(a, b, lambda x, y: F.abs(x - y)), lambda d: d > most)


def links(nodes: DataFrame, max_bits: int) -> DataFrame:
    """``u, v``: links that connect all nodes (distinct ``fp``) within
    ``max_bits`` (at most 2: see the module) of each other."""
    if not 0 < max_bits <= 2:
        raise ValueError("pairs of quarters find links of at most 2 bits")
    table = cut(nodes.select("fp", pivot_distances(F.col("fp")).alias("pivots")), "pivots")
    filed = table.select("fp", F.explode(block_keys(F.col("fp"), F.col("pivots"))).alias("key"))
    sizes = filed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = cut(filed.join(sizes, "key"), "blocks")

    few = shared.filter(F.col("n") <= BLOCK).select("key", "fp").join(table, "fp")
    left = few.select("key", F.col("fp").alias("u"), F.col("pivots").alias("pu"))
    right = few.select("key", F.col("fp").alias("v"), F.col("pivots").alias("pv"))
    close = (
        left.join(right, "key")
        .filter("u > v")
        .filter(~_far_apart(F.col("pu"), F.col("pv"), max_bits))
        .filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits)
        .select("u", "v")
    )

    # a centre one bit away links at 2 bits; at 1 bit only the centre's own node does
    crowd = shared.filter(F.col("n") > BLOCK).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *(F.lit(_signed(1 << b)) for b in range(BITS)))
    near = crowd.select("fp", F.explode(flips).alias("flip"))
    near = near.select("fp", "flip", F.col("fp").bitwiseXOR(F.col("flip")).alias("centre"))
    if max_bits == 2:
        star = near.groupBy("centre").agg(F.collect_set("fp").alias("fps"))  # 65 at most
        star = star.filter(F.size("fps") > 1).select(F.explode("fps").alias("u"), F.array_min("fps").alias("v"))
    else:
        star = near.filter("flip <> 0").select(F.col("fp").alias("u"), F.col("centre").alias("v"))
        star = star.join(crowd.select(F.col("fp").alias("v")), "v", "left_semi").select("u", "v")
    return close.union(star.filter("u <> v")).distinct()


def near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    max_bits: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col, fingerprint`` (16 hex digits)``, component_id`` of every row:
    the smallest id reachable over links, its own included."""
    fps = cut(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    nodes = fps.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    found = components(links(nodes, max_bits))
    linked = nodes.join(found, nodes.fp == found.node)
    best = linked.groupBy("root").agg(F.min("least").alias("best"))
    of_linked = linked.join(best, "root").select("fp", "best")
    of_node = (
        nodes.join(of_linked, "fp", "left")
        .select("fp", "copies", F.coalesce("best", "least").alias("component_id"))
    )
    # a fingerprint of many copies is one key of the last join: those rows find their node in a broadcast
    # table (one row per COPIES rows at most, measured), or, past its bound, are left to skew splitting
    of_node = cut(of_node, "components")
    hot, small = checked_broadcast(of_node.filter(F.col("copies") > COPIES).drop("copies"))
    of_node = of_node.drop("copies")
    found = fps.join(of_node, "fp")
    if small:
        at_hand = fps.join(hot.withColumnRenamed("fp", "hot"), F.col("fp") == F.col("hot"), "left")
        rest = at_hand.filter("hot IS NULL").drop("hot", "component_id")
        found = at_hand.filter("hot IS NOT NULL").drop("hot").unionByName(rest.join(of_node, "fp"))
    return found.select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )
