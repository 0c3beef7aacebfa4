"""Fixed values and tunables.

The values under "fixed values" must stay equal to the source pipeline's so
that results match; everything else is a tunable of this Spark build.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# fixed values (must equal the reference pipeline's for identical results)
# ---------------------------------------------------------------------------
CARD_ID_COLUMN = "card_number"
TARGET_COLUMN = "label"

RANDOM_STATE = 42
TEST_SIZE = 0.20
CLASSIFICATION_THRESHOLD = 0.50

SMALL_TRANSACTION_AMOUNT = 2_000.0
LARGE_TRANSACTION_AMOUNT = 50_000.0

TRUTHY_VALUES = ("1", "true", "t", "yes", "y")
FALSEY_VALUES = ("0", "false", "f", "no", "n")

# what the card features read of a prepared transaction
FEATURE_REQUIRED_COLUMNS = [
    CARD_ID_COLUMN,
    TARGET_COLUMN,
    "transaction_amount_kzt",
    "merchant_id",
    "mcc",
    "country",
    "merchant_country",
    "channel",
    "tokenized",
    "Is_recurring",
    "recurring_capable",
    "transaction_date",
    "transaction_datetime",
]

REQUIRED_TRANSACTION_COLUMNS = (CARD_ID_COLUMN, "transaction_amount_kzt", "merchant_id")

# optional transaction columns and the value used when a source lacks them
OPTIONAL_TRANSACTION_DEFAULTS = {
    "transaction_date": None,
    "transaction_timestamp": None,
    "mcc": None,
    "channel": "unknown",
    "bank_name": None,
    "country": None,
    "card_tier": None,
    "tokenized": False,
    "Is_recurring": False,
}

OPTIONAL_MERCHANT_DEFAULTS = {
    "merchant_name": None,
    "merchant_country": None,
    "recurring_capable": False,
}

# exploratory MCC list analysed for business share (in the published order)
TOP20_MCC = (
    "8651", "5942", "4011", "3958", "3700", "3724", "3245", "3828", "3612", "5733",
    "3904", "8699", "3924", "3182", "3774", "3578", "3928", "6011", "3503", "3235",
)

# household MCC codes used for the per-category amount features
MCC_SUPERMARKET = "5411"
MCC_RESTAURANT = "5812"
MCC_TAXI = "4121"

# class names used by the per-class report, in label order 0, 1
CLASS_NAMES = ("consumer", "business_like")

# model candidates as published: LR max_iter, RF trees / min leaf
LR_MAX_ITER = 1_000
RF_NUM_TREES = 300
RF_MIN_INSTANCES_PER_NODE = 3

TOP_FEATURES_IN_SUMMARY = 15

# ---------------------------------------------------------------------------
# tunables of the Spark build
# ---------------------------------------------------------------------------
# Number of hash buckets of the card split (bucket < TEST_SIZE * buckets -> test).
SPLIT_BUCKETS = 1000
# Spark ML trees need a finite depth; this is the largest it accepts.
RF_MAX_DEPTH = 30
# Candidate split points per feature (Spark's default of 32 coarsens amounts).
RF_MAX_BINS = 128
# Tree groups of the forest, each with a bootstrap sample and class weights of its own.
RF_GROUPS = 10
# Cards of one partition of a forest fit: every partition sends a histogram of every node.
RF_PARTITION_CARDS = 250_000
# Model fits whose jobs run side by side (all tree groups); each holds its sample of the feature matrix.
FIT_THREADS = 10
# Tree nodes that the fits running side by side may bring into the driver at the worst (about 0.6 KB each). A forest of
# up to half as many is one Spark ML model, which scoring sends out whole; a larger one is fitted and saved in parts.
RF_DRIVER_NODES = 400_000
# Parts fitted or scored side by side: besides its trees, the driver holds the splits of a pass for each.
RF_PART_THREADS = 6
