"""Segment union, keep-first dedup and the merchant-dimension join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.operators.clean import add_target, normalize_merchants, normalize_transactions
from cardlens.operators.joins import join_dimension


def dedup_keep_first(df: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """One row per ``key``: the first row under a declared total order.

    Spark frames have no row order, so "first" is the smallest row by
    ``order`` (default: all other columns in schema order, ascending, nulls
    last). Expressed as ``min(struct(...))`` per key, which is a plain
    aggregate: it combines map-side before the shuffle, so a key holding a
    large share of rows never lands in one task as raw rows (a
    ``row_number`` window would sort that whole key in one task).
    """
    others = [c for c in df.columns if c != key]
    order = list(order) if order else others
    sort_key = []
    for c in order:
        sort_key += [F.col(c).isNull(), F.col(c)]
    rest = [c for c in others if c not in order]
    packed = F.struct(
        *[s.alias(f"_k{i}") for i, s in enumerate(sort_key)],
        *[F.col(c).alias(f"_v_{c}") for c in order + rest],
    )
    first = df.groupBy(key).agg(F.min(packed).alias("_first"))
    return first.select(key, *[F.col(f"_first._v_{c}").alias(c) for c in others])


def concat_strict(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Vertical concat that requires identical schemas (names, order, types).

    Plan-time check only; raises ``ValueError`` naming the first difference.
    """
    want = [(f.name, f.dataType.simpleString()) for f in first.schema.fields]
    out = first
    for i, df in enumerate(others, start=1):
        got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
        if got != want:
            diff = next(
                (f"{a} vs {b}" for a, b in zip(want, got) if a != b),
                f"{len(want)} vs {len(got)} columns",
            )
            raise ValueError(f"frame {i} does not match the first frame's schema: {diff}")
        out = out.union(df)
    return out


def frame_shape(df: DataFrame) -> tuple[int, int]:
    """(rows, columns): one count job, the column count is plan-time."""
    return df.count(), len(df.columns)


def combine_transactions(business: DataFrame, consumer: DataFrame, infer_datetimes: bool = False) -> DataFrame:
    """Normalize both segments (each with its own date formats, if they are inferred),
    label them (business=1, consumer=0), union.

    ``unionByName`` matches columns by name and widens numeric types; a column
    present on one side only raises, as a strict vertical concat does.
    """
    b = add_target(normalize_transactions(business, "business_cards", infer_datetimes), 1)
    c = add_target(normalize_transactions(consumer, "consumer_cards", infer_datetimes), 0)
    return b.unionByName(c)


def label_by_flag(raw: DataFrame, flag: str, name: str = "transactions") -> DataFrame:
    """Normalize a source that holds both segments and carries a boolean
    segment flag (true = business). Same rows and labels as splitting it into
    two frames and :func:`combine_transactions`, in one pass: the source (and
    any join that produced it) is computed once."""
    labelled = raw.withColumn("_segment", F.coalesce(F.col(flag), F.lit(False))).drop(flag)
    cleaned = normalize_transactions(labelled, name)
    return cleaned.withColumn(
        "label", F.when(F.col("_segment"), F.lit(1)).otherwise(F.lit(0)).cast("byte")
    ).drop("_segment")


def merge_merchants(transactions: DataFrame, merchants_reference: DataFrame) -> DataFrame:
    """Left join of transactions to the cleaned merchant dimension.

    The merchant dimension is not bounded by construction, so it is measured
    first (:func:`checked_broadcast`): broadcast when it fits the session's
    broadcast threshold, so the transactions are never shuffled for the join;
    otherwise both sides shuffle on ``merchant_id``, the rows of merchants that are counted
    as hot spread over parts (:func:`cardlens.operators.joins.salted_left_join`).
    """
    merchants = normalize_merchants(merchants_reference)
    merged = join_dimension(transactions, merchants, on="merchant_id", how="left")
    return merged.withColumns(
        {
            "merchant_country": F.coalesce(F.col("merchant_country"), F.lit("unknown")),
            "recurring_capable": F.coalesce(F.col("recurring_capable"), F.lit(False)),
        }
    )


def prepare_transactions(
    business: DataFrame, consumer: DataFrame, merchants_reference: DataFrame, infer_datetimes: bool = False
) -> DataFrame:
    """Full transaction-level preparation: clean, label, union, enrich."""
    return merge_merchants(combine_transactions(business, consumer, infer_datetimes), merchants_reference)
