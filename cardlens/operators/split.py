"""Card-level train/test split by a stable hash bucket.

Each card's bucket is ``md5(card || ':' || seed)`` (first 32 bits) modulo
``SPLIT_BUCKETS``; buckets below ``test_size * SPLIT_BUCKETS`` form the test
set. Row-local (no shuffle, no sort, no collect), independent of partitioning,
and stable as data grows: a card never changes side. Because the hash is
independent of the label, each class is split in the same proportion in
expectation, which is what stratification asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.config import CARD_ID_COLUMN, RANDOM_STATE, SPLIT_BUCKETS, TARGET_COLUMN, TEST_SIZE


def split_bucket(card: Column, seed: int = RANDOM_STATE, buckets: int = SPLIT_BUCKETS) -> Column:
    digest = F.md5(F.concat(card.cast("string"), F.lit(f":{seed}")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % buckets).cast("int")


def assign_split(
    cards: DataFrame,
    test_size: float = TEST_SIZE,
    seed: int = RANDOM_STATE,
    buckets: int = SPLIT_BUCKETS,
) -> DataFrame:
    cut = int(round(test_size * buckets))
    b = split_bucket(F.col(CARD_ID_COLUMN), seed, buckets)
    return cards.withColumn("split_bucket", b).withColumn("is_test", F.col("split_bucket") < cut)


def assign_split_exact(
    cards: DataFrame, test_size: float = TEST_SIZE, seed: int = RANDOM_STATE
) -> DataFrame:
    """Exactly ``round(test_size * n_c)`` test cards in every class c.

    Cards are ordered within their class by (md5 hash, card) and the first
    ones form the test set. The rank comes from the range-partitioned running
    count (:func:`cardlens.operators.ranking.ordered_cumulative`), not a
    ``row_number`` over the label, which would put each class — half the data
    or more — into one task.
    """
    from cardlens.operators.ranking import ordered_cumulative

    digest = F.md5(F.concat(F.col(CARD_ID_COLUMN).cast("string"), F.lit(f":{seed}")))
    keyed = cards.select(
        CARD_ID_COLUMN,
        TARGET_COLUMN,
        F.concat(digest, F.lit("|"), F.col(CARD_ID_COLUMN).cast("string")).alias("_order"),
        F.lit(1).cast("long").alias("_one"),
    )
    ranked = ordered_cumulative(keyed, [TARGET_COLUMN], "_order", "_one")
    per_class = cards.groupBy(TARGET_COLUMN).agg(F.count(F.lit(1)).alias("_n"))  # one row per class
    cut = per_class.select(
        TARGET_COLUMN, F.round(F.col("_n") * F.lit(float(test_size))).cast("long").alias("_cut")
    )
    flags = ranked.join(F.broadcast(cut), TARGET_COLUMN).select(
        CARD_ID_COLUMN, (F.col("_cum_before") < F.col("_cut")).alias("is_test")
    )
    return cards.join(flags, CARD_ID_COLUMN)


def feature_columns(cards: DataFrame) -> list[str]:
    """Model inputs: every column except the card id, the label and split tags."""
    excluded = {CARD_ID_COLUMN, TARGET_COLUMN, "split_bucket", "is_test"}
    return [c for c in cards.columns if c not in excluded]


def split_train_test(
    cards: DataFrame, test_size: float = TEST_SIZE, seed: int = RANDOM_STATE, exact: bool = False
) -> tuple[DataFrame, DataFrame, list[str]]:
    """(train, test, feature columns); ``exact`` gives exact per-class shares."""
    cols = feature_columns(cards)
    if not cols:
        raise ValueError(f"nothing to train on among {cards.columns}")
    if exact:
        tagged = assign_split_exact(cards, test_size, seed).withColumn("split_bucket", F.lit(0))
    else:
        tagged = assign_split(cards, test_size, seed)
    train = tagged.filter(~F.col("is_test")).drop("split_bucket", "is_test")
    test = tagged.filter(F.col("is_test")).drop("split_bucket", "is_test")
    return train, test, cols
