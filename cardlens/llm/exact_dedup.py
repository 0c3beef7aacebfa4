"""Exact duplicates of a batch against an immutable snapshot, by static filters.

* A *snapshot* holds one row per distinct normalised text (digest, the row that
  stays, group size) and one binary fuse filter per digest bucket; it is
  written once and never changed.
* A new batch is first *grouped by itself* (partial aggregation, so copies
  collapse before the shuffle).
* Its distinct digests meet the bucket's filter; a "no" is certain and needs no
  look-up in the snapshot.
* *Positives* join the snapshot's exact bucket; where both know the digest, the
  two whole texts are compared byte for byte before the groups are joined. If
  bytes differ (a SHA-256 collision) the groups stay apart.

Buckets hold about ``BUCKET_KEYS`` digests whatever the size of the data, and
only digests travel, but for the texts of positives.

Defined cases: null counts as an empty text; of equal texts the smallest id
stays, null ids last; where that id is repeated, one of its rows stays;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.llm import fuse_filter
from cardlens.llm.scratch import cut
from cardlens.llm.url_filter import block_count, bloom, may_hold, url_hash

BUCKET_KEYS = 4096
FILTER_TYPE = "bucket int, seed int, length int, segments int, slots binary"


def normalise(text: Column) -> Column:
    """Every run of white space becomes one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digest(text: Column) -> Column:
    return F.sha2(normalise(text), 256)


def key_of(name: str) -> Column:
    return F.xxhash64(name)


def fingerprint_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row, id, digest`` of every row, written: the narrow table of all
    later steps (``row`` tells repeated rows apart and is fixed by the write)."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        digest(F.col(text_col)).alias("digest"),
    )
    return cut(rows, "digests")


def group(rows: DataFrame) -> DataFrame:
    """``digest, keep, n``: ``keep`` is the row that stays."""
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row"))
    return rows.groupBy("digest").agg(first.alias("keep"), F.count("*").alias("n"))


def bucket_count(rows: int) -> int:
    """A power of two, so that buckets of a larger snapshot split smaller ones."""
    return 1 << max(0, (max(rows, 1) - 1) // BUCKET_KEYS).bit_length()


def with_bucket(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.hash("digest"), F.lit(buckets)).cast("int"))


def build_filters(snapshot: DataFrame, buckets: int) -> DataFrame:
    """One static filter per bucket of a snapshot's digests."""

    def one(table: pa.Table) -> pa.Table:
        made = fuse_filter.build(table.column("key").to_numpy().view(np.uint64))
        row = {"bucket": table.column("bucket")[0].as_py()} | made
        return pa.Table.from_pylist(
            [row],
            pa.schema(
                [("bucket", pa.int32()), ("seed", pa.int32()), ("length", pa.int32()),
                 ("segments", pa.int32()), ("slots", pa.binary())]
            ),
        )

    keys = with_bucket(snapshot, buckets).select("bucket", key_of("digest").alias("key"))
    return keys.groupBy("bucket").applyInArrow(one, FILTER_TYPE)


def screen(groups: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """The digests of ``groups`` that may be in the snapshot: ``digest``."""

    def one(left: pa.Table, right: pa.Table) -> pa.Table:
        digests = left.column("digest")
        if not right.num_rows:
            return pa.table({"digest": digests.slice(0, 0)})
        f = right.select(["seed", "length", "segments", "slots"]).to_pylist()[0]
        hit = fuse_filter.maybe(left.column("key").to_numpy().view(np.uint64), **f)
        return pa.table({"digest": digests.filter(pa.array(hit))})

    keys = with_bucket(groups, buckets).select("bucket", "digest", key_of("digest").alias("key"))
    pairs = keys.groupBy("bucket").cogroup(filters.groupBy("bucket"))
    return pairs.applyInArrow(one, "digest string")


def same_bytes(
    docs: DataFrame, pairs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Byte check of ``digest, a, b`` (two ids that claim the digest):
    ``digest`` where the two normalised texts are identical.

    A Bloom filter of the claimed ids (bounded size) keeps most other texts out of the
    shuffle. The claims grow with the data, so they are never broadcast."""
    wanted = cut(pairs.select("digest", F.explode(F.array("a", "b")).alias("id")).distinct(), "claims")
    blocks = block_count(wanted.count())
    claimed = cut(bloom(wanted, blocks, "id"), "claimed")
    near = docs.filter(may_hold(claimed.scalar(), blocks, url_hash(F.col(id_col))))
    texts = near.select(
        F.col(id_col).alias("id"), digest(F.col(text_col)).alias("digest"),
        normalise(F.col(text_col)).alias("text"),
    )
    same_row = (texts.digest == wanted.digest) & texts.id.eqNullSafe(wanted.id)
    found = texts.join(wanted.hint("merge"), same_row, "left_semi")
    return (
        found.groupBy("digest")
        .agg(F.min("text").alias("low"), F.max("text").alias("high"))
        .filter(F.col("low") == F.col("high"))
        .select("digest")
    )


def merge_batch(
    docs: DataFrame, snapshot: DataFrame, filters: DataFrame, batch: DataFrame, buckets: int,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Groups after the batch: ``digest, for_old, for_new, keep, n``. Where the
    bytes of batch and snapshot differ, each side keeps a group of its own;
    else a group is for both. ``snapshot`` and ``batch``: see :func:`group`."""
    positive = cut(screen(batch, filters, buckets), "positives")
    known = snapshot.select("digest", F.col("keep").alias("old"), F.col("n").alias("old_n"))
    # exact buckets: the filter's false positives fall out here
    both = cut(batch.join(positive, "digest").join(known, "digest"), "both")
    claims = both.select("digest", F.col("keep.id").alias("a"), F.col("old.id").alias("b"))
    same = same_bytes(docs, claims, id_col, text_col).withColumn("same", F.lit(True))
    both = cut(both.join(same, "digest", "left").fillna(False, "same"), "checked")

    def rows_of(df: DataFrame, for_old: bool, for_new: bool, keep: Column, n: Column) -> DataFrame:
        sides = F.lit(for_old).alias("for_old"), F.lit(for_new).alias("for_new")
        return df.select("digest", *sides, keep.alias("keep"), n.alias("n"))

    keep, n, old, old_n = (F.col(c) for c in ("keep", "n", "old", "old_n"))
    parts = [
        rows_of(both.filter("same"), True, True, F.least(keep, old), n + old_n),
        rows_of(both.filter("not same"), False, True, keep, n),
        rows_of(both.filter("not same"), True, False, old, old_n),
        rows_of(batch.join(both, "digest", "left_anti"), True, True, keep, n),
        rows_of(snapshot.join(both, "digest", "left_anti"), True, True, keep, n),
    ]
    return reduce(DataFrame.unionByName, parts)


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every row of ``docs`` with its group: ``id_col, keep_id, group_size, kept,
    text_sha256``. The lower half of the id range is the snapshot, the rest
    (and rows without an id) is the batch that comes in."""
    rows = fingerprint_rows(docs, id_col, text_col)
    middle = rows.agg(F.percentile_approx("id", 0.5)).first()[0] if _numeric(rows, "id") else None
    old = F.coalesce(F.col("id") <= F.lit(middle), F.lit(False)) if middle is not None else F.lit(False)
    rows = rows.withColumn("old", old)
    snapshot = cut(group(rows.filter("old")), "snapshot")
    batch = cut(group(rows.filter("not old")), "batch")
    buckets = bucket_count(max(snapshot.count(), batch.count()))
    filters = cut(build_filters(snapshot, buckets), "filters")
    groups = merge_batch(docs, snapshot, filters, batch, buckets, id_col, text_col)
    mine = (rows.digest == groups.digest) & F.when(rows.old, groups.for_old).otherwise(groups.for_new)
    return rows.join(groups, mine).select(
        F.col("id").alias(id_col),
        F.col("keep.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("keep.row")).alias("kept"),
        rows.digest.alias("text_sha256"),
    )


def _numeric(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.typeName() in ("long", "integer", "short", "byte", "decimal")
