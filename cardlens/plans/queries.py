"""Named queries over a benchmark folder, each with its DuckDB oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` builds a lazy plan over the
given tables (through the fixture adapters); ``ORACLE[name]`` is the same
result in DuckDB SQL over the pre-registered views. Queries without an
oracle (model fits) get a rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.config import (
    CARD_ID_COLUMN,
    CLASS_NAMES,
    FEATURE_REQUIRED_COLUMNS,
    RANDOM_STATE,
    RF_GROUPS,
    SPLIT_BUCKETS,
    TEST_SIZE,
    TOP20_MCC,
)
from cardlens.operators import clean, enrich, evaluate, features, forest, layout, mcc, score_tables, split, state
from cardlens.operators.joins import join_dimension
from cardlens.operators.materialize import materialize, scratch_path
from cardlens.plans import oracle as O
from cardlens.sources import fixtures
from cardlens.sources.tables import table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# -- shared plan fragments -----------------------------------------------------


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return fixtures.event_sources(spark, sf_dir)


def flagged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned, labelled events from one scan: the segment flag labels each
    row (same rows and labels as normalizing the two segment frames and
    uniting them, which the ``label_union`` query checks, without scanning and
    parsing the source once per segment)."""
    return enrich.label_by_flag(raw_events(spark, sf_dir), "is_business", "events")


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    merchants = fixtures.merchants_reference(
        table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    )
    return enrich.merge_merchants(flagged_events(spark, sf_dir), merchants)


def card_features_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.build_card_level_features(prepared(spark, sf_dir))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.event_transactions(table(spark, sf_dir, "events"))


# -- S1, S2: sources ---------------------------------------------------------------


@register(
    "scan_sources",
    O.with_ctes(
        """SELECT 'business_cards' AS source, count(*) AS n_rows FROM raw_txn WHERE is_business
UNION ALL SELECT 'consumer_cards', count(*) FROM raw_txn WHERE NOT is_business
UNION ALL SELECT 'merchants_reference', count(*) FROM mer_raw""",
        base=[O.RAW_TXN, O.MERCHANTS],
    ),
)
def scan_sources(spark, sf_dir):
    frames = sources(spark, sf_dir)
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("source"), "n_rows")
        for name, df in frames.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# -- P1-P10: cleaning --------------------------------------------------------------


@register(
    "parse_bool_flags",
    O.with_ctes(
        f"""SELECT transaction_id, tokenized AS tokenized_raw, {O.bool_sql('tokenized')} AS tokenized,
       Is_recurring AS is_recurring_raw, {O.bool_sql('Is_recurring')} AS is_recurring
FROM raw_txn""",
        base=[O.RAW_TXN],
    ),
)
def parse_bool_flags(spark, sf_dir):
    from cardlens.functions.parsing import bool_expr

    raw = raw_events(spark, sf_dir)
    return raw.select(
        "transaction_id",
        F.col("tokenized").alias("tokenized_raw"),
        bool_expr(raw, "tokenized").alias("tokenized"),
        F.col("Is_recurring").alias("is_recurring_raw"),
        bool_expr(raw, "Is_recurring").alias("is_recurring"),
    )


@register(
    "parse_dates",
    O.with_ctes(
        f"""SELECT transaction_id, transaction_date AS date_raw,
       {O.date_sql('transaction_date')} AS transaction_date,
       {O.date_sql('transaction_timestamp')} AS date_from_timestamp
FROM raw_txn""",
        base=[O.RAW_TXN],
    ),
)
def parse_dates(spark, sf_dir):
    from cardlens.functions.parsing import date_expr

    raw = raw_events(spark, sf_dir)
    return raw.select(
        "transaction_id",
        F.col("transaction_date").alias("date_raw"),
        date_expr(raw, "transaction_date").alias("transaction_date"),
        date_expr(raw, "transaction_timestamp").alias("date_from_timestamp"),
    )


@register(
    "parse_timestamps",
    O.with_ctes(
        f"""SELECT transaction_id, transaction_timestamp AS timestamp_raw,
       {O.ts_sql('transaction_timestamp')} AS transaction_timestamp,
       {O.ts_sql('transaction_date')} AS timestamp_from_date
FROM raw_txn""",
        base=[O.RAW_TXN],
    ),
)
def parse_timestamps(spark, sf_dir):
    from cardlens.functions.parsing import timestamp_expr

    raw = raw_events(spark, sf_dir)
    return raw.select(
        "transaction_id",
        F.col("transaction_timestamp").alias("timestamp_raw"),
        timestamp_expr(raw, "transaction_timestamp").alias("transaction_timestamp"),
        timestamp_expr(raw, "transaction_date").alias("timestamp_from_date"),
    )


_FOREIGN = """
src AS (
  SELECT event_id AS transaction_id,
         CASE WHEN event_id % 17 = 0 THEN 'n/a' WHEN event_id % 10 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
              ELSE strftime(ts, '%d %b %Y %I:%M %p') END AS named,
         CASE WHEN event_id % 13 <> 0 THEN strftime(ts, '%m/%d/%Y %H:%M:%S') END AS month_first,
         strftime(ts, '%d.%m.%y') AS short_year
  FROM events)"""
# column -> (format, DuckDB pattern) of each format that its texts could have, in the library's order
_FOREIGN_FORMATS = {
    "named": [("year-month-day", "%Y-%m-%d %H:%M:%S"), ("day month-name year", "%d %b %Y %I:%M %p")],
    "month_first": [("day-month-year", "%d/%m/%Y %H:%M:%S"), ("month-day-year", "%m/%d/%Y %H:%M:%S")],
    "short_year": [("day-month-short-year", "%d.%m.%y"), ("month-day-short-year", "%m.%d.%y")],
}


def _voted_sql(c: str, kind: str) -> str:
    """Value, format and share of one column: the second format wins with more votes only."""
    (a, pa), (b, pb) = _FOREIGN_FORMATS[c]
    first, second = f"try_strptime({c}, '{pa}')", f"try_strptime({c}, '{pb}')"
    n1, n2 = f"(SELECT count({first}) FROM src)", f"(SELECT count({second}) FROM src)"
    value = f"CASE WHEN {n2} > {n1} THEN coalesce({second}, {first}) ELSE coalesce({first}, {second}) END"
    return (
        f"CAST({value} AS {kind}) AS {c}, CASE WHEN {n2} > {n1} THEN '{b}' ELSE '{a}' END AS {c}_format, "
        f"greatest({n1}, {n2})::DOUBLE / (SELECT count({c}) FROM src) AS {c}_share"
    )


@register(
    "parse_inferred",
    O.with_ctes(
        "SELECT transaction_id, "
        + ", ".join(_voted_sql(c, "DATE" if c == "short_year" else "TIMESTAMP") for c in _FOREIGN_FORMATS)
        + " FROM src",
        base=[_FOREIGN],
    ),
)
def parse_inferred(spark, sf_dir):
    """Formats that the fixed set lacks: each column's own format by a vote over its values."""
    from cardlens.functions.inference import parse_inferred as infer

    raw = fixtures.foreign_dates(table(spark, sf_dir, "events"))
    kinds = {"named": "timestamp", "month_first": "timestamp", "short_year": "date"}
    return infer(raw, {c: (c, kind) for c, kind in kinds.items()})


# amount text variants: plain, Java double suffix, padded, missing
_AMOUNT_TEXT_SQL = """CASE transaction_id % 10
    WHEN 0 THEN printf('%.2f', transaction_amount_kzt) || 'd'
    WHEN 1 THEN ' ' || printf('%.2f', transaction_amount_kzt) || ' '
    WHEN 2 THEN NULL
    ELSE printf('%.2f', transaction_amount_kzt) END"""


@register(
    "normalize_amount",
    O.with_ctes(
        f"""SELECT transaction_id, amount_text, {O.amount_sql('amount_text')} AS transaction_amount_kzt
FROM (SELECT transaction_id, {_AMOUNT_TEXT_SQL} AS amount_text FROM raw_txn)""",
        base=[O.RAW_TXN],
    ),
)
def normalize_amount(spark, sf_dir):
    from cardlens.functions.parsing import double_expr

    raw = raw_events(spark, sf_dir)
    text = F.format_string("%.2f", F.col("transaction_amount_kzt"))
    i = F.col("transaction_id") % 10
    variants = raw.select(
        "transaction_id",
        F.when(i == 0, F.concat(text, F.lit("d")))
        .when(i == 1, F.concat(F.lit(" "), text, F.lit(" ")))
        .when(i == 2, F.lit(None).cast("string"))
        .otherwise(text)
        .alias("amount_text"),
    )
    return variants.select(
        "transaction_id",
        "amount_text",
        double_expr(variants, "amount_text").alias("transaction_amount_kzt"),
    )


_NORMALIZED_COLS = (
    "transaction_id, card_number, transaction_amount_kzt, merchant_id, mcc, channel, country, "
    "tokenized, Is_recurring, transaction_date, transaction_timestamp, bank_name, card_tier, "
    "transaction_datetime"
)


@register("normalize_txn", O.with_ctes(f"SELECT {_NORMALIZED_COLS} FROM clean_txn", base=[O.RAW_TXN, O.CLEAN_TXN]))
def normalize_txn(spark, sf_dir):
    raw = raw_events(spark, sf_dir).drop("is_business")
    return clean.normalize_transactions(raw, "events").select(*_NORMALIZED_COLS.split(", "))


@register(
    "txn_datetime_fallback",
    O.with_ctes(
        "SELECT transaction_id, transaction_timestamp, transaction_date, transaction_datetime FROM clean_txn",
        base=[O.RAW_TXN, O.CLEAN_TXN],
    ),
)
def txn_datetime_fallback(spark, sf_dir):
    raw = raw_events(spark, sf_dir).drop("is_business")
    return clean.normalize_transactions(raw).select(
        "transaction_id", "transaction_timestamp", "transaction_date", "transaction_datetime"
    )


@register(
    "channel_mix",
    O.with_ctes(
        "SELECT channel, label, count(*) AS n_transactions FROM clean_txn GROUP BY channel, label",
        base=[O.RAW_TXN, O.CLEAN_TXN],
    ),
)
def channel_mix(spark, sf_dir):
    s = sources(spark, sf_dir)
    txn = enrich.combine_transactions(s["business_cards"], s["consumer_cards"])
    return txn.groupBy("channel", "label").agg(F.count(F.lit(1)).alias("n_transactions"))


# -- P4, U1-U3, J1, P11-P13: union, merchants, join -----------------------------------


@register(
    "label_union",
    O.with_ctes(f"SELECT {_NORMALIZED_COLS}, label FROM clean_txn", base=[O.RAW_TXN, O.CLEAN_TXN]),
)
def label_union(spark, sf_dir):
    s = sources(spark, sf_dir)
    txn = enrich.combine_transactions(s["business_cards"], s["consumer_cards"])
    return txn.select(*_NORMALIZED_COLS.split(", "), "label")


@register("merchants_dim", O.with_ctes("SELECT * FROM mer_dim", base=[O.MERCHANTS]))
def merchants_dim(spark, sf_dir):
    return clean.normalize_merchants(sources(spark, sf_dir)["merchants_reference"])


@register(
    "merchants_dedup",
    O.with_ctes(
        """SELECT c.merchant_id, c.n_raw_rows, d.merchant_name AS kept_name,
       d.merchant_country AS kept_country, d.recurring_capable AS kept_recurring_capable
FROM (SELECT merchant_id, count(*) AS n_raw_rows FROM mer_clean GROUP BY merchant_id) c
JOIN mer_dim d ON c.merchant_id = d.merchant_id""",
        base=[O.MERCHANTS],
    ),
)
def merchants_dedup(spark, sf_dir):
    raw = clean.clean_merchants(sources(spark, sf_dir)["merchants_reference"])
    counts = raw.groupBy("merchant_id").agg(F.count(F.lit(1)).alias("n_raw_rows"))
    kept = enrich.dedup_keep_first(raw, "merchant_id")
    return counts.join(kept, "merchant_id").select(
        "merchant_id",
        "n_raw_rows",
        F.col("merchant_name").alias("kept_name"),
        F.col("merchant_country").alias("kept_country"),
        F.col("recurring_capable").alias("kept_recurring_capable"),
    )


_ENRICHED_COLS = (
    _NORMALIZED_COLS
    + ", label, merchant_name, merchant_country, recurring_capable, merchant_reference_mcc"
)


@register(
    "txn_enriched",
    O.with_ctes(f"SELECT {_ENRICHED_COLS} FROM txn", base=[O.RAW_TXN, O.CLEAN_TXN, O.MERCHANTS, O.ENRICHED]),
)
def txn_enriched(spark, sf_dir):
    return prepared(spark, sf_dir).select(*_ENRICHED_COLS.split(", "))


@register(
    "merchant_country_mix",
    O.with_ctes(
        """SELECT merchant_country, label, count(*) AS n_transactions,
       sum(transaction_amount_kzt) AS total_amount
FROM txn GROUP BY merchant_country, label""",
        base=[O.RAW_TXN, O.CLEAN_TXN, O.MERCHANTS, O.ENRICHED],
    ),
)
def merchant_country_mix(spark, sf_dir):
    return (
        prepared(spark, sf_dir)
        .groupBy("merchant_country", "label")
        .agg(
            F.count(F.lit(1)).alias("n_transactions"),
            F.sum("transaction_amount_kzt").alias("total_amount"),
        )
    )


# -- indicators and card features (A1-A28) ------------------------------------------


@register(
    "behavior_indicators",
    O.with_ctes(
        "SELECT transaction_id, card_number, "
        + ", ".join(i for i, _ in O._SHARES)
        + " FROM ind",
        base=[O.RAW_TXN, O.CLEAN_TXN, O.MERCHANTS, O.ENRICHED, O.INDICATORS],
    ),
)
def behavior_indicators(spark, sf_dir):
    ind = features.add_behavior_indicators(prepared(spark, sf_dir))
    return ind.select("transaction_id", CARD_ID_COLUMN, *features.INDICATOR_COLUMNS)


def _block_query(block: str, cols: list[str]):
    sql = O.with_ctes(f"SELECT card_number, label, {', '.join(cols)} FROM card_feat")

    def fn(spark, sf_dir):
        return features.card_feature_block(prepared(spark, sf_dir), block)

    return sql, fn


for _name, _block, _cols in [
    ("card_activity", "activity", features.ACTIVITY_FEATURES),
    ("card_diversity", "diversity", features.DIVERSITY_FEATURES),
    ("card_channel_shares", "channel", features.CHANNEL_SHARES),
    ("card_time_shares", "time", features.TIME_SHARES),
    ("card_amount_shares", "amount", features.AMOUNT_SHARES),
    ("card_ratios", "ratios", features.RATIO_FEATURES),
]:
    _sql, _fn = _block_query(_block, _cols)
    register(_name, _sql)(_fn)


@register(
    "card_features",
    O.with_ctes(
        f"SELECT card_number, label, {', '.join(features.CARD_FEATURES)} FROM card_feat"
    ),
)
def card_features(spark, sf_dir):
    return card_features_df(spark, sf_dir)


# -- S6 with A2-A28 from daily states; A5, A8-A12 from sketches --------------------------


def _state_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(prepared(spark, sf_dir).select(*FEATURE_REQUIRED_COLUMNS), "prepared-transactions")


@register("card_features_incremental", ORACLE["card_features"])
def card_features_incremental(spark, sf_dir):
    """Card features merged from daily states that three updates wrote: days before the 16th of a month,
    later days, and transactions without a date."""
    txn, path = _state_input(spark, sf_dir), scratch_path(spark, "card-states")
    for part in (F.day("transaction_date") < 16, F.day("transaction_date") >= 16, F.isnull("transaction_date")):
        state.update_states(txn.filter(part), path)
    return state.merge_features(spark, path)


@register("card_features_bucketed", ORACLE["card_features"])
def card_features_bucketed(spark, sf_dir):
    """Card features from a layout bucketed by card; cards of over 100 transactions are kept beside it."""
    path = scratch_path(spark, "card-layout")
    layout.write_layout(_state_input(spark, sf_dir), path, large_rows=100)
    return layout.layout_features(layout.open_layout(spark, path))


@register(
    "card_sketches",
    O.with_ctes(
        "SELECT card_number, total_transactions, true AS days_close, true AS merchants_close, true AS mcc_close, "
        "true AS countries_close, true AS merchant_countries_close, true AS median_close, true AS q95_close FROM card_feat"
    ),
)
def card_sketches(spark, sf_dir):
    """Estimates merged from daily sketches, held against exact counts and ranks of the same cards:
    counts within 8 % or 1 (five standard errors), ranks within 5 %."""
    txn, path = _state_input(spark, sf_dir), scratch_path(spark, "card-sketches")
    state.update_sketches(txn, path)
    merged = state.merge_sketches(state.read_state(spark, path, "sketches"), {"_median": 0.5, "_q95": 0.95})
    estimates = materialize(merged, "estimates")
    exact = features.distinct_counts(txn, list(features.DISTINCT_FEATURES))
    exact = exact.withColumnsRenamed({n: f"_{n}" for n in features.DISTINCT_FEATURES})
    amount = F.col(features.AMOUNT)
    side = estimates.select(CARD_ID_COLUMN, "_median", "_q95")
    ranks = join_dimension(txn.select(CARD_ID_COLUMN, amount), side, CARD_ID_COLUMN)
    ranks = ranks.groupBy(CARD_ID_COLUMN).agg(
        *(F.avg((amount < F.col(q)).cast("double")).alias(f"{q}_below") for q in ("_median", "_q95")),
        *(F.avg((amount <= F.col(q)).cast("double")).alias(f"{q}_up_to") for q in ("_median", "_q95")),
    )
    out = estimates.join(exact, CARD_ID_COLUMN).join(ranks, CARD_ID_COLUMN)

    def close(n: str):
        return F.abs(F.col(n) - F.col(f"_{n}")) <= F.greatest(F.col(f"_{n}") * 0.08, F.lit(1.0))

    def near(q: str, rank: float):
        return (F.col(f"{q}_below") <= rank + 0.05) & (F.col(f"{q}_up_to") >= rank - 0.05)

    return out.select(
        CARD_ID_COLUMN,
        "total_transactions",
        close("active_days").alias("days_close"),
        close("unique_merchants").alias("merchants_close"),
        close("unique_mcc").alias("mcc_close"),
        close("unique_countries").alias("countries_close"),
        close("unique_merchant_countries").alias("merchant_countries_close"),
        near("_median", 0.5).alias("median_close"),
        near("_q95", 0.95).alias("q95_close"),
    )


# -- exploratory MCC family (G1-G11, J3, J4) -------------------------------------------



def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned, labelled transactions of both segments (no merchant join)."""
    return flagged_events(spark, sf_dir)


_CLEAN = [O.RAW_TXN, O.CLEAN_TXN]
_WEIGHTS = """
w AS (SELECT mcc, avg(CAST(label AS DOUBLE)) AS mcc_b2b_weight FROM clean_txn GROUP BY mcc)"""
_Q95 = """
q95 AS (
  SELECT card_number, v AS global_quantile_95 FROM (
    SELECT card_number, v,
           row_number() OVER (PARTITION BY card_number ORDER BY v) - 1 AS pos,
           count(*) OVER (PARTITION BY card_number) AS n
    FROM (SELECT card_number,
                 CASE WHEN isnan(transaction_amount_kzt) THEN NULL ELSE transaction_amount_kzt END AS v
          FROM {src}) WHERE v IS NOT NULL)
  WHERE pos = CAST(round(CAST(0.95 AS DOUBLE) * CAST(n - 1 AS DOUBLE)) AS BIGINT)
)"""


@register(
    "mcc_mix_topk",
    O.with_ctes(
        f"""SELECT mcc, count(*) AS total_count, CAST(sum(label) AS BIGINT) AS business_count,
       CAST(count_if(label = 0) AS BIGINT) AS consumer_count,
       CAST(sum(label) AS DOUBLE) / count(*) AS business_share
FROM clean_txn WHERE mcc IN {O._in(TOP20_MCC)} GROUP BY mcc""",
        base=_CLEAN,
    ),
)
def mcc_mix_topk(spark, sf_dir):
    return mcc.mcc_mix(labelled(spark, sf_dir))


@register("mcc_b2b_weight", O.with_ctes("SELECT * FROM w", base=_CLEAN + [_WEIGHTS]))
def mcc_b2b_weight(spark, sf_dir):
    return mcc.mcc_weights(labelled(spark, sf_dir))


@register(
    "card_b2b_index",
    O.with_ctes(
        """SELECT t.card_number, CAST(max(t.label) AS TINYINT) AS label,
       avg(w.mcc_b2b_weight) AS card_b2b_index
FROM clean_txn t LEFT JOIN w ON t.mcc = w.mcc GROUP BY t.card_number""",
        base=_CLEAN + [_WEIGHTS],
    ),
)
def card_b2b_index(spark, sf_dir):
    return mcc.b2b_index(labelled(spark, sf_dir))


@register(
    "card_amount_q95",
    O.with_ctes("SELECT * FROM q95", base=_CLEAN + [_Q95.format(src="clean_txn")]),
)
def card_amount_q95(spark, sf_dir):
    return mcc.card_amount_q95(labelled(spark, sf_dir))


_HOUSEHOLD = """
hh AS (
  SELECT t.card_number, CAST(max(t.label) AS TINYINT) AS label,
         max(CASE WHEN isnan(t.transaction_amount_kzt) THEN NULL ELSE t.transaction_amount_kzt END) AS global_max_amount,
         avg(t.transaction_amount_kzt) AS global_mean_amount,
         avg(w.mcc_b2b_weight) AS card_b2b_index,
         max(t.transaction_amount_kzt) FILTER (WHERE t.mcc = '5411') AS max_amount_mcc_5411,
         sum(t.transaction_amount_kzt) FILTER (WHERE t.mcc = '5411') AS sum_amount_mcc_5411,
         max(t.transaction_amount_kzt) FILTER (WHERE t.mcc = '5812') AS max_amount_mcc_5812,
         sum(t.transaction_amount_kzt) FILTER (WHERE t.mcc = '4121') AS sum_amount_mcc_4121
  FROM clean_txn t LEFT JOIN w ON t.mcc = w.mcc GROUP BY t.card_number
),
household AS (
  SELECT hh.card_number, coalesce(label, 0) AS label,
         coalesce(global_max_amount, 0.0) AS global_max_amount,
         coalesce(global_mean_amount, 0.0) AS global_mean_amount,
         coalesce(card_b2b_index, 0.0) AS card_b2b_index,
         coalesce(max_amount_mcc_5411, 0.0) AS max_amount_mcc_5411,
         coalesce(sum_amount_mcc_5411, 0.0) AS sum_amount_mcc_5411,
         coalesce(max_amount_mcc_5812, 0.0) AS max_amount_mcc_5812,
         coalesce(sum_amount_mcc_4121, 0.0) AS sum_amount_mcc_4121,
         coalesce(q95.global_quantile_95, 0.0) AS global_quantile_95
  FROM hh LEFT JOIN q95 ON hh.card_number = q95.card_number
)"""

_HOUSEHOLD_CTES = _CLEAN + [_WEIGHTS, _Q95.format(src="clean_txn"), _HOUSEHOLD]


@register("card_household_mcc", O.with_ctes("SELECT * FROM household", base=_HOUSEHOLD_CTES))
def card_household_mcc(spark, sf_dir):
    return mcc.household_features(labelled(spark, sf_dir))


def _extended_sql(src: str, weight: str, name: str, q95: str) -> str:
    return f"""
{name}_agg AS (
  SELECT card_number, CAST(max(label) AS TINYINT) AS label,
         max(CASE WHEN isnan(transaction_amount_kzt) THEN NULL ELSE transaction_amount_kzt END) AS global_max_amount,
         avg({weight}) AS card_b2b_index,
         avg(CAST(hour(transaction_timestamp) BETWEEN 0 AND 5 AS DOUBLE)) AS night_trans_share,
         avg(CAST(hour(transaction_timestamp) BETWEEN 9 AND 18 AS DOUBLE)) AS working_hours_share,
         avg(CAST(channel = 'online' AS DOUBLE)) AS online_share,
         avg(CAST(Is_recurring = true AS DOUBLE)) AS recurring_share
  FROM {src} GROUP BY card_number
),
{name} AS (
  SELECT a.card_number, coalesce(a.label, 0) AS label,
         coalesce(global_max_amount, 0.0) AS global_max_amount,
         coalesce(q.global_quantile_95, 0.0) AS global_quantile_95,
         coalesce(card_b2b_index, 0.0) AS card_b2b_index,
         coalesce(night_trans_share, 0.0) AS night_trans_share,
         coalesce(working_hours_share, 0.0) AS working_hours_share,
         coalesce(online_share, 0.0) AS online_share,
         coalesce(recurring_share, 0.0) AS recurring_share
  FROM {name}_agg a LEFT JOIN {q95} q ON a.card_number = q.card_number
)"""


_EXT_SRC = """
ext_src AS (SELECT t.*, w.mcc_b2b_weight FROM clean_txn t LEFT JOIN w ON t.mcc = w.mcc)"""
_EXTENDED_CTES = _CLEAN + [
    _WEIGHTS,
    _Q95.format(src="clean_txn"),
    _EXT_SRC,
    _extended_sql("ext_src", "mcc_b2b_weight", "extended", "q95"),
]


@register("card_extended", O.with_ctes("SELECT * FROM extended", base=_EXTENDED_CTES))
def card_extended(spark, sf_dir):
    return mcc.extended_features(labelled(spark, sf_dir))


def _bucket_sql(card: str) -> str:
    return f"(('0x' || substr(md5({card} || ':{RANDOM_STATE}'), 1, 8))::BIGINT % {SPLIT_BUCKETS})"


_TEST_CUT = int(round(TEST_SIZE * SPLIT_BUCKETS))
_SAFE = [
    f"""
tr AS (SELECT * FROM clean_txn WHERE {_bucket_sql('card_number')} >= {_TEST_CUT}),
te AS (SELECT * FROM clean_txn WHERE {_bucket_sql('card_number')} < {_TEST_CUT}),
sw AS (SELECT mcc, avg(CAST(label AS DOUBLE)) AS mcc_b2b_weight FROM tr GROUP BY mcc),
tr_w AS (SELECT tr.* REPLACE (coalesce(tr.transaction_amount_kzt, 0.0) AS transaction_amount_kzt),
                coalesce(sw.mcc_b2b_weight, 0.0) AS w FROM tr LEFT JOIN sw ON tr.mcc = sw.mcc),
te_w AS (SELECT te.* REPLACE (coalesce(te.transaction_amount_kzt, 0.0) AS transaction_amount_kzt),
                coalesce(sw.mcc_b2b_weight, 0.0) AS w FROM te LEFT JOIN sw ON te.mcc = sw.mcc)""",
    _Q95.format(src="tr_w").replace("q95 AS", "q_tr AS"),
    _Q95.format(src="te_w").replace("q95 AS", "q_te AS"),
    _extended_sql("tr_w", "w", "f_tr", "q_tr"),
    _extended_sql("te_w", "w", "f_te", "q_te"),
]


@register(
    "encode_train_apply",
    O.with_ctes(
        "SELECT *, 'train' AS split FROM f_tr UNION ALL SELECT *, 'test' AS split FROM f_te",
        base=_CLEAN + _SAFE,
    ),
)
def encode_train_apply(spark, sf_dir):
    t = labelled(spark, sf_dir)
    is_test = split.split_bucket(F.col(CARD_ID_COLUMN)) < _TEST_CUT
    cards = mcc.build_safe_features(t.withColumn(mcc.SIDE, F.coalesce(is_test, F.lit(False))))
    side = F.when(F.col(mcc.SIDE), "test").otherwise("train")
    return cards.withColumn("split", side).drop(mcc.SIDE)


_PROFILE_HH = ["global_max_amount", "global_quantile_95", "card_b2b_index", "max_amount_mcc_5411"]
_PROFILE_EXT = ["night_trans_share", "working_hours_share", "online_share", "recurring_share"]


@register(
    "class_profile",
    O.with_ctes(
        "SELECT label, " + ", ".join(f"avg({c}) AS mean_{c}" for c in _PROFILE_HH)
        + " FROM household GROUP BY label",
        base=_HOUSEHOLD_CTES,
    ),
)
def class_profile(spark, sf_dir):
    return mcc.class_profile(mcc.household_features(labelled(spark, sf_dir)), _PROFILE_HH)


@register(
    "class_profile_extended",
    O.with_ctes(
        "SELECT label, " + ", ".join(f"avg({c}) AS mean_{c}" for c in _PROFILE_EXT)
        + " FROM extended GROUP BY label",
        base=_EXTENDED_CTES,
    ),
)
def class_profile_extended(spark, sf_dir):
    return mcc.class_profile(mcc.extended_features(labelled(spark, sf_dir)), _PROFILE_EXT)


@register(
    "card_sanity_check",
    O.with_ctes(
        """SELECT card_number,
       count(DISTINCT mcc) + max(CASE WHEN mcc IS NULL THEN 1 ELSE 0 END) AS unique_mcc_count,
       count(transaction_amount_kzt) AS total_trans,
       stddev_samp(transaction_amount_kzt) AS amount_std,
       avg(transaction_amount_kzt) AS amount_mean
FROM clean_txn GROUP BY card_number ORDER BY card_number LIMIT 10""",
        base=_CLEAN,
    ),
)
def card_sanity_check(spark, sf_dir):
    return mcc.card_sanity_check(labelled(spark, sf_dir))


# -- lazy prototype chain (S3, J2, P19) --------------------------------------------------


@register(
    "proto_txn_time",
    O.with_ctes(
        f"""SELECT transaction_id, card_number, merchant_id, target, merchant_name, mcc, mcc_right, dt,
       CAST(hour(dt) AS INTEGER) AS hour, CAST(isodow(dt) AS INTEGER) AS dayofweek,
       CAST(isodow(dt) IN (6, 7) AS INTEGER) AS is_weekend,
       CAST(hour(dt) BETWEEN 9 AND 18 AS INTEGER) AS is_business_hour
FROM (SELECT r.transaction_id, r.card_number, r.merchant_id,
             CAST(CASE WHEN r.is_business THEN 1 ELSE 0 END AS INTEGER) AS target,
             m.merchant_name, r.mcc, m.mcc AS mcc_right,
             {O.ts_sql('r.transaction_timestamp')} AS dt
      FROM raw_txn r LEFT JOIN mer_raw m ON r.merchant_id = CAST(m.merchant_id AS VARCHAR))""",
        base=[O.RAW_TXN, O.MERCHANTS],
    ),
)
def proto_txn_time(spark, sf_dir):
    from cardlens.operators.prototype import prototype_time_features

    s = sources(spark, sf_dir)
    out = prototype_time_features(s["business_cards"], s["consumer_cards"], s["merchants_reference"])
    return out.select(
        "transaction_id", "card_number", "merchant_id", "target", "merchant_name", "mcc",
        "mcc_right", "dt", "hour", "dayofweek", "is_weekend", "is_business_hour",
    )


# -- split, class weights, standardization (M1, M6, M3) --------------------------------------


@register(
    "split_stratified",
    O.with_ctes(
        f"""SELECT card_number, label, CAST({_bucket_sql('card_number')} AS INTEGER) AS split_bucket,
       {_bucket_sql('card_number')} < {_TEST_CUT} AS is_test FROM card_feat"""
    ),
)
def split_stratified(spark, sf_dir):
    cards = features.card_labels(flagged_events(spark, sf_dir))
    return split.assign_split(cards).select(CARD_ID_COLUMN, "label", "split_bucket", "is_test")


@register(
    "split_stratified_exact",
    O.with_ctes(
        f"""SELECT card_number, label, pos < CAST(round(n * CAST({TEST_SIZE} AS DOUBLE)) AS BIGINT) AS is_test
FROM (SELECT card_number, label,
             row_number() OVER (PARTITION BY label
                                ORDER BY md5(card_number || ':{RANDOM_STATE}') || '|' || card_number) - 1 AS pos,
             count(*) OVER (PARTITION BY label) AS n
      FROM card_feat)"""
    ),
)
def split_stratified_exact(spark, sf_dir):
    from cardlens.operators.materialize import materialize

    cards = materialize(features.card_labels(flagged_events(spark, sf_dir)), "card-labels")
    return split.assign_split_exact(cards).select(CARD_ID_COLUMN, "label", "is_test")


_TRAIN_CARDS = f"""
train_cards AS (SELECT * FROM card_feat WHERE {_bucket_sql('card_number')} >= {_TEST_CUT})"""


@register(
    "class_weights",
    O.with_ctes(
        """SELECT label, n_cards,
       CAST(sum(n_cards) OVER () AS DOUBLE) / (count(*) OVER () * n_cards) AS class_weight
FROM (SELECT label, count(*) AS n_cards FROM train_cards GROUP BY label)""",
        extra=[_TRAIN_CARDS],
    ),
)
def class_weights(spark, sf_dir):
    from cardlens.operators.model import class_weight_table

    cards = split.assign_split(features.card_labels(flagged_events(spark, sf_dir)))
    return class_weight_table(cards.filter(~F.col("is_test")))


def _draws_sql(card: str, group: str) -> str:
    place = f"('0x' || substr(md5(concat_ws(':', {card}, {RANDOM_STATE}, {group})), 1, {forest.HASH_DIGITS}))::BIGINT"
    return " + ".join(f"CAST({place} >= {cut} AS INTEGER)" for cut in forest.draw_cuts())


@register(
    "bootstrap_weights",
    O.with_ctes(
        """SELECT tree_group, label, n_cards, n_draws,
       CAST(sum(n_draws) OVER (PARTITION BY tree_group) AS DOUBLE)
         / (count(*) OVER (PARTITION BY tree_group) * n_draws) AS class_weight
FROM (SELECT tree_group, label, count(*) AS n_cards, CAST(sum(draws) AS BIGINT) AS n_draws
      FROM drawn WHERE draws > 0 GROUP BY tree_group, label)""",
        extra=[
            _TRAIN_CARDS,
            f"""
drawn AS (SELECT label, CAST(tree_group AS INTEGER) AS tree_group, {_draws_sql('card_number', 'tree_group')} AS draws
          FROM train_cards, range({RF_GROUPS}) AS g(tree_group))""",
        ],
    ),
)
def bootstrap_weights(spark, sf_dir):
    """Class weights of every tree group's bootstrap sample of the training cards."""
    cards = split.assign_split(features.card_labels(flagged_events(spark, sf_dir)))
    return forest.bootstrap_weights(cards.filter(~F.col("is_test")), RF_GROUPS)


def _standardize_sql() -> str:
    stats = ", ".join(
        f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in features.CARD_FEATURES
    )
    zs = ", ".join(
        f"({c} - m_{c}) / CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 1.0 ELSE s_{c} END AS {c}"
        for c in features.CARD_FEATURES
    )
    return O.with_ctes(
        f"SELECT card_number, label, {zs} FROM card_feat, "
        f"(SELECT {stats} FROM train_cards) st",
        extra=[_TRAIN_CARDS],
    )


@register("standardize_features", _standardize_sql())
def standardize_features(spark, sf_dir):
    from cardlens.operators.materialize import materialize
    from cardlens.operators.model import standardize

    cards = materialize(card_features_df(spark, sf_dir), "card-features")
    train, _, cols = split.split_train_test(cards)
    return standardize(cards, train, cols).select(CARD_ID_COLUMN, "label", *cols)


# -- evaluation over a scored frame (P22, W3, S7, E1-E4, M9) -------------------------------

_SCORED = """
scored AS (
  SELECT CAST(c_custkey AS VARCHAR) AS card_number,
         CAST(c_mktsegment IN ('BUILDING', 'MACHINERY') AS INTEGER) AS y_true,
         CAST(least(greatest(round(c_acctbal / 1000) / 10, CAST(0.0 AS DOUBLE)), CAST(1.0 AS DOUBLE)) AS DOUBLE) AS y_proba
  FROM customer
),
pred AS (SELECT *, CAST(y_proba >= 0.5 AS INTEGER) AS y_pred FROM scored),
cm AS (
  SELECT CAST(count_if(y_true = 1 AND y_pred = 1) AS BIGINT) AS tp,
         CAST(count_if(y_true = 0 AND y_pred = 1) AS BIGINT) AS fp,
         CAST(count_if(y_true = 1 AND y_pred = 0) AS BIGINT) AS fn,
         CAST(count_if(y_true = 0 AND y_pred = 0) AS BIGINT) AS tn
  FROM pred
)"""


def _eval_sql(select: str) -> str:
    return O.with_ctes(select, base=[_SCORED])


def scored_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = fixtures.scored_customers(table(spark, sf_dir, "customer"))
    return evaluate.predict_with_threshold(scored)


@register("predict_threshold", _eval_sql("SELECT card_number, y_true, y_pred, y_proba FROM pred"))
def predict_threshold(spark, sf_dir):
    return scored_predictions(spark, sf_dir).select("card_number", "y_true", "y_pred", "y_proba")


@register(
    "predictions_ranked",
    _eval_sql("SELECT card_number, y_true, y_pred, y_proba FROM pred ORDER BY y_proba DESC, card_number"),
)
def predictions_ranked(spark, sf_dir):
    return (
        scored_predictions(spark, sf_dir)
        .select("card_number", "y_true", "y_pred", "y_proba")
        .orderBy(F.desc("y_proba"), F.asc("card_number"))
    )


@register(
    "confusion_matrix",
    _eval_sql(
        """SELECT 0 AS y_true, 0 AS y_pred, tn AS n FROM cm UNION ALL SELECT 0, 1, fp FROM cm
UNION ALL SELECT 1, 0, fn FROM cm UNION ALL SELECT 1, 1, tp FROM cm"""
    ),
)
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(scored_predictions(spark, sf_dir))


_P = "CASE WHEN {d} > 0 THEN CAST({n} AS DOUBLE) / ({d}) ELSE 0.0 END"


@register(
    "binary_metrics",
    _eval_sql(
        "SELECT tp, fp, fn, tn, "
        + _P.format(n="tp + tn", d="tp + fp + fn + tn") + " AS accuracy, "
        + _P.format(n="tp", d="tp + fp") + " AS precision, "
        + _P.format(n="tp", d="tp + fn") + " AS recall, "
        + _P.format(n="2 * tp", d="2 * tp + fp + fn") + " AS f1 FROM cm"
    ),
)
def binary_metrics(spark, sf_dir):
    return evaluate.binary_metrics(scored_predictions(spark, sf_dir))


_REPORT = """
per AS (
  SELECT 'consumer' AS class_name, {p0} AS precision, {r0} AS recall, {f0} AS f1_score, tn + fp AS support FROM cm
  UNION ALL
  SELECT 'business_like', {p1}, {r1}, {f1}, tp + fn FROM cm
)""".format(
    p0=_P.format(n="tn", d="tn + fn"), r0=_P.format(n="tn", d="tn + fp"),
    f0=_P.format(n="2 * tn", d="2 * tn + fn + fp"),
    p1=_P.format(n="tp", d="tp + fp"), r1=_P.format(n="tp", d="tp + fn"),
    f1=_P.format(n="2 * tp", d="2 * tp + fp + fn"),
)


@register(
    "classification_report",
    O.with_ctes(
        """SELECT class_name, precision, recall, f1_score, CAST(support AS BIGINT) AS support FROM per
UNION ALL SELECT 'accuracy', NULL, NULL, (SELECT """ + _P.format(n="tp + tn", d="tp + fp + fn + tn") + """ FROM cm),
  (SELECT tp + fp + fn + tn FROM cm)
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), CAST(sum(support) AS BIGINT) FROM per
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1_score * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per""",
        base=[_SCORED, _REPORT],
    ),
)
def classification_report(spark, sf_dir):
    return evaluate.classification_report(scored_predictions(spark, sf_dir))


@register(
    "roc_auc",
    _eval_sql(
        """SELECT CASE WHEN p > 0 AND n > 0 THEN (rank_sum - p * (p + 1) / 2.0) / (CAST(p AS DOUBLE) * n) END AS roc_auc
FROM (SELECT sum(CASE WHEN y_true = 1 THEN r ELSE 0 END) AS rank_sum,
             count_if(y_true = 1) AS p, count_if(y_true <> 1) AS n
      FROM (SELECT y_true, rank() OVER (ORDER BY y_proba) + (count(*) OVER (PARTITION BY y_proba) - 1) / 2.0 AS r
            FROM scored))"""
    ),
)
def roc_auc(spark, sf_dir):
    return evaluate.roc_auc(scored_predictions(spark, sf_dir))


@register(
    "rank_consumers",
    O.with_ctes(
        """SELECT card_number, card_b2b_index AS score FROM (
  SELECT card_number, label, card_b2b_index FROM f_tr UNION ALL SELECT card_number, label, card_b2b_index FROM f_te)
WHERE label = 0 ORDER BY score DESC, card_number""",
        base=_CLEAN + _SAFE,
    ),
)
def rank_consumers(spark, sf_dir):
    scored = encode_train_apply(spark, sf_dir)
    return (
        scored.filter(F.col("label") == 0)
        .select(CARD_ID_COLUMN, F.col("card_b2b_index").alias("score"))
        .orderBy(F.desc("score"), F.asc(CARD_ID_COLUMN))
    )


# -- model fits (M2-M7): the fits themselves are beyond SQL, their optimum is not ------------


def _split_cards(spark: SparkSession, sf_dir: str):
    from cardlens.operators.materialize import materialize

    return split.split_train_test(materialize(card_features_df(spark, sf_dir), "card-features"))


def _scores(spark, sf_dir, name):
    from cardlens.operators import model as M

    train, test, cols = _split_cards(spark, sf_dir)
    fitted = M.train_models(train, cols, names=(name,))[name]
    return evaluate.predict_with_threshold(M.score_cards(fitted, test)).select(
        "card_number", "y_true", "y_pred", "y_proba"
    )


_GAPS = {"avg_amount": 7, "unique_mcc": 5, "night_share": 3}


@register(
    "impute_medians",
    O.with_ctes(
        "SELECT card_number, " + ", ".join(f"coalesce({c}, median({c}) OVER ()) AS {c}" for c in _GAPS) + " FROM gaps",
        extra=[
            "gaps AS (SELECT card_number, "
            + ", ".join(f"CASE WHEN CAST(card_number AS BIGINT) % {k} <> 0 THEN CAST({c} AS DOUBLE) END AS {c}" for c, k in _GAPS.items())
            + " FROM card_feat)"
        ],
    ),
)
def impute_medians(spark, sf_dir):
    """Features with gaps (null and NaN), filled with the exact medians of the known values by the models' own stage."""
    from cardlens.operators import model as M

    card = F.col(CARD_ID_COLUMN).cast("long")
    missing = F.when(card % 2 == 0, F.lit(float("nan")))
    cards = materialize(card_features_df(spark, sf_dir), "card-features")
    gaps = {c: F.when(card % k != 0, F.col(c).cast("double")).otherwise(missing) for c, k in _GAPS.items()}
    cards = materialize(cards.select(CARD_ID_COLUMN, *(e.alias(c) for c, e in gaps.items())), "gaps")
    filled = M.impute_stage(list(gaps), M.fit_medians(cards, list(gaps))).transform(cards)
    return filled.select(CARD_ID_COLUMN, *(F.col(f"_imp_{c}").alias(c) for c in gaps))


@register("score_logistic")
def score_logistic(spark, sf_dir):
    return _scores(spark, sf_dir, "logistic_regression")


@register("score_forest")
def score_forest(spark, sf_dir):
    return _scores(spark, sf_dir, "random_forest")


@register(
    "logistic_optimum",
    "SELECT unnest([" + ", ".join(f"'{c}'" for c in features.CARD_FEATURES) + "]) AS feature, true AS at_optimum",
)
def logistic_optimum(spark, sf_dir):
    """The regularised loss is flat at the fitted coefficients, feature by feature."""
    from cardlens.operators import model as M

    train, _, cols = _split_cards(spark, sf_dir)
    fitted = M.train_models(train, cols, names=("logistic_regression",))["logistic_regression"]
    slopes = M.logistic_gradient(fitted, train, cols)
    return slopes.select("feature", (F.abs("gradient") < 1e-4).alias("at_optimum"))


# fixed values: a linear and a forest table for scoring without a fitted model
LINEAR_ROWS = [
    (None, -1.0),
    ("online_share", 2.0),
    ("night_share", -1.5),
    ("amount_cv", 0.5),
    ("transactions_per_active_day", 0.25),
]
NODE_ROWS = [
    (0, 0, "total_transactions", 60.0, 1, 4, None),
    (0, 1, "online_share", 0.2, 2, 3, None),
    (0, 2, None, None, None, None, 0.25),
    (0, 3, None, None, None, None, 0.5),
    (0, 4, None, None, None, None, 0.75),
    (1, 0, "avg_amount", 10000.0, 1, 2, None),
    (1, 1, None, None, None, None, 0.125),
    (1, 2, "unique_merchants", 20.0, 3, 4, None),
    (1, 3, None, None, None, None, 0.375),
    (1, 4, None, None, None, None, 0.875),
    (2, 0, None, None, None, None, 0.5),
]


@register(
    "score_by_tables",
    O.with_ctes("""SELECT card_number,
  1.0 / (1.0 + exp(1.0 - 2.0 * online_share + 1.5 * night_share - 0.5 * amount_cv
                   - 0.25 * transactions_per_active_day)) AS linear_score,
  (CASE WHEN total_transactions > 60 THEN 0.75 WHEN online_share > 0.2 THEN 0.5 ELSE 0.25 END
   + CASE WHEN avg_amount <= 10000 THEN 0.125 WHEN unique_merchants <= 20 THEN 0.375 ELSE 0.875 END
   + 0.5) / 3 AS forest_score
FROM card_feat"""),
)
def score_by_tables(spark, sf_dir):
    """Every card scored from a table of coefficients and a table of tree nodes."""
    cards, cols = materialize(card_features_df(spark, sf_dir), "card-features"), features.CARD_FEATURES
    linear = spark.createDataFrame(LINEAR_ROWS, score_tables.LINEAR_SCHEMA)
    nodes = spark.createDataFrame(NODE_ROWS, score_tables.NODE_SCHEMA)
    by_line = score_tables.score_linear(cards, linear, cols, "linear_score").select(CARD_ID_COLUMN, "linear_score")
    by_forest = score_tables.score_forest(cards, nodes, CARD_ID_COLUMN, cols, 2, "forest_score")
    return by_line.join(by_forest, CARD_ID_COLUMN)


def _gini_sql(where: str) -> str:
    n, p = f"count_if({where})", f"count_if({where} AND label = 1)"
    return f"coalesce({n} - ({p} * {p} + ({n} - {p}) * ({n} - {p}))::DOUBLE / nullif({n}, 0), 0.0)"


def _decrease_sql(where: str, test: str) -> str:
    return f"{_gini_sql(where)} - {_gini_sql(f'{where} AND {test}')} - {_gini_sql(f'{where} AND NOT {test}')}"


@register(
    "importance_by_tables",
    O.with_ctes(
        "SELECT feature, coalesce(share, 0.0) / sum(share) OVER () AS importance FROM (SELECT unnest(["
        + ", ".join(f"'{c}'" for c in features.CARD_FEATURES)
        + "]) AS feature) LEFT JOIN shares USING (feature)",
        extra=[
            f"""
falls AS (SELECT {_decrease_sql('true', '(total_transactions <= 60)')} AS a,
                 {_decrease_sql('(total_transactions <= 60)', '(online_share <= 0.2)')} AS b,
                 {_decrease_sql('true', '(avg_amount <= 10000)')} AS c,
                 {_decrease_sql('(avg_amount > 10000)', '(unique_merchants <= 20)')} AS d FROM card_feat),
shares AS (
  SELECT 'total_transactions' AS feature, a / (a + b) AS share FROM falls UNION ALL SELECT 'online_share', b / (a + b) FROM falls
  UNION ALL SELECT 'avg_amount', c / (c + d) FROM falls UNION ALL SELECT 'unique_merchants', d / (c + d) FROM falls)"""
        ],
    ),
)
def importance_by_tables(spark, sf_dir):
    """Impurity importance of the fixed node table, measured on all cards."""
    cards = materialize(card_features_df(spark, sf_dir), "card-features")
    nodes = spark.createDataFrame(NODE_ROWS, score_tables.NODE_SCHEMA)
    return score_tables.forest_importance(cards, nodes, "label", features.CARD_FEATURES, 2)


# -- selection, importance, summary (M8, E5, E6, W1, S8) over two scorers that SQL can express --


def _two_scorers(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    pred = scored_predictions(spark, sf_dir).select("card_number", "y_true", "y_pred", "y_proba")
    other = pred.withColumn("y_proba", F.pmod(F.col("card_number").cast("long"), F.lit(11)) / 10.0)
    return {"balance_rule": pred, "key_rule": evaluate.predict_with_threshold(other)}


_BEST = """
key_scored AS (SELECT card_number, y_true, (CAST(card_number AS BIGINT) % 11) / 10.0::DOUBLE AS y_proba FROM scored),
both_pred AS (
  SELECT 0 AS position, 'balance_rule' AS model_name, y_true, y_proba, CAST(y_proba >= 0.5 AS INTEGER) AS y_pred FROM scored
  UNION ALL
  SELECT 1, 'key_rule', y_true, y_proba, CAST(y_proba >= 0.5 AS INTEGER) FROM key_scored),
both_cm AS (
  SELECT position, model_name, count_if(y_true = 1 AND y_pred = 1)::BIGINT AS tp, count_if(y_true = 0 AND y_pred = 1)::BIGINT AS fp,
         count_if(y_true = 1 AND y_pred = 0)::BIGINT AS fn, count_if(y_true = 0 AND y_pred = 0)::BIGINT AS tn
  FROM both_pred GROUP BY ALL),
both_auc AS (
  SELECT model_name, (sum(CASE WHEN y_true = 1 THEN r ELSE 0 END) - count_if(y_true = 1) * (count_if(y_true = 1) + 1) / 2.0)
         / (count_if(y_true = 1)::DOUBLE * count_if(y_true <> 1)) AS roc_auc
  FROM (SELECT model_name, y_true, rank() OVER (PARTITION BY model_name ORDER BY y_proba)
               + (count(*) OVER (PARTITION BY model_name, y_proba) - 1) / 2.0 AS r FROM both_pred)
  GROUP BY model_name),
compared AS (
  SELECT *, row_number() OVER (ORDER BY roc_auc DESC, position) = 1 AS is_best FROM (
    SELECT position, model_name, tp, fp, fn, tn, roc_auc, {acc} AS accuracy, {p} AS precision, {r} AS recall, {f} AS f1
    FROM both_cm JOIN both_auc USING (model_name)))""".format(
    acc=_P.format(n="tp + tn", d="tp + fp + fn + tn"),
    p=_P.format(n="tp", d="tp + fp"),
    r=_P.format(n="tp", d="tp + fn"),
    f=_P.format(n="2 * tp", d="2 * tp + fp + fn"),
)


@register(
    "select_best_model",
    O.with_ctes("SELECT model_name, roc_auc, f1, is_best FROM compared", base=[_SCORED, _BEST]),
)
def select_best_model(spark, sf_dir):
    from cardlens.plans.pipeline import compare

    return compare(_two_scorers(spark, sf_dir)).select("model_name", "roc_auc", "f1", "is_best")


def _mean_gap_importance(cards: DataFrame) -> DataFrame:
    """Distance of the class means of each feature: an importance that needs no fit."""
    gap = {
        c: F.abs(
            F.avg(F.when(F.col("label") == 1, F.col(c))) - F.avg(F.when(F.col("label") == 0, F.col(c)))
        )
        for c in features.CARD_FEATURES
    }
    wide = cards.agg(*[F.round(F.coalesce(g, F.lit(0.0)), 6).alias(c) for c, g in gap.items()])
    rows = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("importance")) for c in gap]
    return wide.select(F.inline(F.array(*rows))).withColumn("importance_type", F.lit("mean_gap"))


_IMPORTANCE = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(coalesce(abs(avg(CASE WHEN label = 1 THEN {c} END)"
    f" - avg(CASE WHEN label = 0 THEN {c} END)), 0), 6) AS importance FROM card_feat"
    for c in features.CARD_FEATURES
)


@register(
    "importance_ranked",
    O.with_ctes(
        "SELECT CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INTEGER) AS rank, feature, importance,"
        f" 'mean_gap' AS importance_type FROM ({_IMPORTANCE})",
    ),
)
def importance_ranked(spark, sf_dir):
    from cardlens.operators.explain import rank_importance

    return rank_importance(_mean_gap_importance(card_features_df(spark, sf_dir)))


@register(
    "metrics_payload",
    O.with_ctes(
        """SELECT (SELECT model_name FROM compared WHERE is_best) AS best_model, 'roc_auc' AS selection_metric, 0.5::DOUBLE AS threshold,
       model_name, accuracy, tp, fp, fn, tn, roc_auc, class_name, c_precision, c_recall, c_f1, support
FROM compared JOIN (
  SELECT model_name, 'consumer' AS class_name, {p0} AS c_precision, {r0} AS c_recall, {f0} AS c_f1, tn + fp AS support FROM both_cm
  UNION ALL SELECT model_name, 'business_like', {p1}, {r1}, {f1}, tp + fn FROM both_cm) USING (model_name)""".format(
            p0=_P.format(n="tn", d="tn + fn"), r0=_P.format(n="tn", d="tn + fp"),
            f0=_P.format(n="2 * tn", d="2 * tn + fn + fp"),
            p1=_P.format(n="tp", d="tp + fp"), r1=_P.format(n="tp", d="tp + fn"),
            f1=_P.format(n="2 * tp", d="2 * tp + fp + fn"),
        ),
        base=[_SCORED, _BEST],
    ),
)
def metrics_payload(spark, sf_dir):
    """The summary document of two scorers, unfolded to one row per model and class."""
    from cardlens.operators.explain import rank_importance
    from cardlens.plans.pipeline import compare, summary_frame

    scorers = _two_scorers(spark, sf_dir)
    pred = scorers["balance_rule"]
    score = pred.agg(F.avg("y_proba").alias("importance"))
    importance = rank_importance(
        score.select(F.lit("y_proba").alias("feature"), "importance", F.lit("mean").alias("importance_type"))
    )
    doc = summary_frame(compare(scorers), importance, ["y_proba"], 0, pred.count())
    models = doc.select("best_model", "selection_metric", "threshold", F.explode("models").alias("m"))
    lines = models.select(
        "best_model", "selection_metric", "threshold", "m.model_name", "m.accuracy",
        "m.tp", "m.fp", "m.fn", "m.tn", "m.roc_auc", F.explode("m.classification_report").alias("c"),
    )
    lines = lines.filter(F.col("c.class_name").isin(*CLASS_NAMES))
    named = {"precision": "c_precision", "recall": "c_recall", "f1_score": "c_f1", "support": "support"}
    return lines.select(
        *[c for c in lines.columns if c != "c"],
        F.col("c.class_name").alias("class_name"),
        *[F.col(f"c.{a}").alias(b) for a, b in named.items()],
    )


# -- flagship at volume: one transaction per order line --------------------------------------


def volume_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines labelled by customer segment in one pass (the fact join is
    computed once, not once per segment)."""
    raw = fixtures.volume_transactions(
        table(spark, sf_dir, "lineitem"),
        table(spark, sf_dir, "orders"),
        table(spark, sf_dir, "customer"),
        table(spark, sf_dir, "part"),
    )
    merchants = fixtures.merchants_reference(table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation"))
    return enrich.merge_merchants(enrich.label_by_flag(raw, "is_business", "order_lines"), merchants)


@register(
    "card_features_volume",
    O.with_ctes(
        f"SELECT card_number, label, {', '.join(features.CARD_FEATURES)} FROM card_feat",
        base=O.VOLUME_CTES,
    ),
)
def card_features_volume(spark, sf_dir):
    return features.build_card_level_features(volume_prepared(spark, sf_dir))
