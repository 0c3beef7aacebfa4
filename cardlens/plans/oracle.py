"""Independent DuckDB SQL for every checkable query.

Written against the pre-registered benchmark views (``events``, ``supplier``,
``nation``, ``customer``, ...). The building blocks below are CTEs that
restate, in plain SQL, the fixture adapters, the cleaning contract, the
merchant join and the card aggregation; each query appends its final SELECT.
"""

from __future__ import annotations

from cardlens.config import (
    FALSEY_VALUES,
    LARGE_TRANSACTION_AMOUNT,
    MCC_RESTAURANT,
    MCC_SUPERMARKET,
    MCC_TAXI,
    SMALL_TRANSACTION_AMOUNT,
    TOP20_MCC,
    TRUTHY_VALUES,
)
from cardlens.sources.fixtures import BUSINESS_SEGMENTS, CHANNEL_TEXT, FLAG_TEXTS


def _q(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


def _cycle_sql(index: str, values) -> str:
    whens = " ".join(f"WHEN {i} THEN {_q(v)}" for i, v in enumerate(values))
    return f"CASE {index} {whens} END"


def bool_sql(x: str) -> str:
    """Flag text rule (string input)."""
    low = f"lower({x})"
    as_one = (
        f"coalesce(CASE WHEN regexp_full_match({x}, '[+-]?[0-9]+') "
        f"THEN TRY_CAST({x} AS DECIMAL(38,0)) = 1 END, false)"
    )
    return (
        f"CASE WHEN {low} IN {_in(FALSEY_VALUES)} THEN false "
        f"ELSE coalesce({low} IN {_in(TRUTHY_VALUES)} OR {as_one}, false) END"
    )


def _datetime_formats() -> list[str]:
    times = ["", " %H:%M", " %H:%M:%S", " %H:%M:%S.%f", "T%H:%M", "T%H:%M:%S", "T%H:%M:%S.%f"]
    fmts = []
    for sep in "-/.":
        for t in times:
            fmts.append(f"%Y{sep}%m{sep}%d{t}")
            fmts.append(f"%d{sep}%m{sep}%Y{t}")
    return fmts


def ts_sql(x: str) -> str:
    """Multi-format text -> TIMESTAMP."""
    fmts = ", ".join(_q(f) for f in _datetime_formats())
    # the zoned texts of the fixture: UTC, and nanoseconds five hours ahead of it
    return (
        f"CASE WHEN {x} LIKE '%000+05:00' THEN try_strptime(left({x}, length({x}) - 9), [{fmts}]) - INTERVAL 5 HOUR "
        f"WHEN {x} LIKE '%Z' THEN try_strptime(left({x}, length({x}) - 1), [{fmts}]) "
        f"ELSE try_strptime({x}, [{fmts}, '%Y%m%d']) END"
    )


def date_sql(x: str) -> str:
    return f"CAST({ts_sql(x)} AS DATE)"


def amount_sql(x: str) -> str:
    """Lenient text -> DOUBLE (no spaces, no suffixes)."""
    return (
        f"CASE WHEN regexp_full_match({x}, '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?') "
        f"THEN TRY_CAST({x} AS DOUBLE) "
        f"WHEN lower({x}) IN ('nan', '+nan', '-nan') THEN CAST('nan' AS DOUBLE) "
        f"WHEN lower({x}) IN ('inf', '+inf', 'infinity', '+infinity') THEN CAST('inf' AS DOUBLE) "
        f"WHEN lower({x}) IN ('-inf', '-infinity') THEN CAST('-inf' AS DOUBLE) END"
    )


def _event_mcc_sql(k: str) -> str:
    top = " ".join(f"WHEN {i} THEN {int(c)}" for i, c in enumerate(TOP20_MCC))
    return (
        f"CASE WHEN {k} % 10 = 0 THEN {int(MCC_SUPERMARKET)} "
        f"WHEN {k} % 10 = 1 THEN {int(MCC_RESTAURANT)} "
        f"WHEN {k} % 10 = 2 THEN {int(MCC_TAXI)} "
        f"ELSE CASE {k} % 20 {top} END END"
    )


_channel = " ".join(f"WHEN {_q(ev)} THEN {_q(t)}" for ev, t in CHANNEL_TEXT.items())

RAW_TXN = f"""
ev AS (
  SELECT *, regexp_extract(props, '[0-9]+', 0) AS k_text,
         TRY_CAST(regexp_extract(props, '[0-9]+', 0) AS INTEGER) AS k
  FROM events
),
raw_txn AS (
  SELECT event_id AS transaction_id,
         user_id AS card_number,
         value * 200 AS transaction_amount_kzt,
         CASE WHEN event_type <> 'error' THEN k_text END AS merchant_id,
         {_event_mcc_sql('k')} AS mcc,
         CASE event_type {_channel} END AS channel,
         CASE WHEN event_id % 3 = 0 THEN strftime(ts, '%d/%m/%Y')
              WHEN event_id % 12 = 4 THEN strftime(ts, '%Y%m%d')
              ELSE strftime(ts, '%Y-%m-%d') END AS transaction_date,
         CASE WHEN event_type <> 'error' THEN
              CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
                   WHEN event_id % 10 = 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
                   WHEN event_id % 10 = 3 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '000+05:00'
                   ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END END AS transaction_timestamp,
         CASE WHEN event_id % 11 <> 0 THEN 'C' || CAST(user_id % 7 AS VARCHAR) END AS country,
         {_cycle_sql('event_id % 8', FLAG_TEXTS)} AS tokenized,
         {_cycle_sql('(event_id + 3) % 8', FLAG_TEXTS)} AS Is_recurring,
         user_id % 4 = 0 AS is_business
  FROM ev
)"""

# cleaning contract (normalize_transactions) over raw_txn, all segments
CLEAN_TXN = f"""
clean_all AS (
  SELECT transaction_id,
         CAST(card_number AS VARCHAR) AS card_number,
         CAST(transaction_amount_kzt AS DOUBLE) AS transaction_amount_kzt,
         CAST(merchant_id AS VARCHAR) AS merchant_id,
         CAST(mcc AS VARCHAR) AS mcc,
         coalesce(lower(channel), 'unknown') AS channel,
         CAST(country AS VARCHAR) AS country,
         {bool_sql('tokenized')} AS tokenized,
         {bool_sql('Is_recurring')} AS Is_recurring,
         {date_sql('transaction_date')} AS transaction_date,
         {ts_sql('transaction_timestamp')} AS transaction_timestamp,
         CAST(NULL AS VARCHAR) AS bank_name,
         CAST(NULL AS VARCHAR) AS card_tier,
         is_business
  FROM raw_txn
),
clean_txn AS (
  SELECT * EXCLUDE (is_business),
         coalesce(transaction_timestamp, CAST(transaction_date AS TIMESTAMP)) AS transaction_datetime,
         CAST(CASE WHEN is_business THEN 1 ELSE 0 END AS TINYINT) AS label
  FROM clean_all
  WHERE card_number IS NOT NULL AND transaction_amount_kzt IS NOT NULL
)"""

MERCHANTS = """
mer_raw AS (
  SELECT s.s_suppkey AS merchant_id, s.s_name AS merchant_name, n.n_name AS merchant_country,
         CAST(s.s_suppkey % 3 = 0 AS INTEGER) AS recurring_capable,
         CAST(s.s_nationkey + 3000 AS VARCHAR) AS mcc
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  UNION ALL
  SELECT s.s_suppkey, s.s_name || ' (alt)', CAST(NULL AS VARCHAR),
         CAST(s.s_suppkey % 3 <> 0 AS INTEGER), CAST(NULL AS VARCHAR)
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  WHERE s.s_acctbal < 0
),
mer_clean AS (
  SELECT CAST(merchant_id AS VARCHAR) AS merchant_id,
         CAST(merchant_name AS VARCHAR) AS merchant_name,
         CAST(merchant_country AS VARCHAR) AS merchant_country,
         coalesce(recurring_capable <> 0, false) AS recurring_capable,
         mcc AS merchant_reference_mcc
  FROM mer_raw
),
mer_dim AS (
  SELECT * FROM mer_clean
  QUALIFY row_number() OVER (
    PARTITION BY merchant_id
    ORDER BY merchant_name ASC NULLS LAST, merchant_country ASC NULLS LAST,
             recurring_capable ASC NULLS LAST, merchant_reference_mcc ASC NULLS LAST) = 1
)"""

ENRICHED = """
txn AS (
  SELECT t.*, m.merchant_name,
         coalesce(m.merchant_country, 'unknown') AS merchant_country,
         coalesce(m.recurring_capable, false) AS recurring_capable,
         m.merchant_reference_mcc
  FROM clean_txn t LEFT JOIN mer_dim m ON t.merchant_id = m.merchant_id
)"""

INDICATORS = f"""
ind AS (
  SELECT *,
         coalesce(channel = 'online', false) AS _is_online,
         coalesce(channel = 'offline', false) AS _is_offline,
         Is_recurring AS _is_recurring,
         tokenized AS _is_tokenized,
         recurring_capable AS _is_recurring_capable,
         coalesce(isodow(transaction_date) >= 6, false) AS _is_weekend,
         coalesce(hour(transaction_datetime) BETWEEN 0 AND 5, false) AS _is_night,
         coalesce(hour(transaction_datetime) BETWEEN 6 AND 11, false) AS _is_morning,
         coalesce(hour(transaction_datetime) BETWEEN 18 AND 23, false) AS _is_evening,
         coalesce(abs(transaction_amount_kzt) < {SMALL_TRANSACTION_AMOUNT}, false) AS _is_small_txn,
         coalesce(abs(transaction_amount_kzt) >= {LARGE_TRANSACTION_AMOUNT}, false) AS _is_large_txn
  FROM txn
)"""

_AMT = "transaction_amount_kzt"
_SHARES = [
    ("_is_online", "online_share"),
    ("_is_offline", "offline_share"),
    ("_is_recurring", "recurring_share"),
    ("_is_tokenized", "tokenized_share"),
    ("_is_recurring_capable", "recurring_capable_share"),
    ("_is_weekend", "weekend_share"),
    ("_is_night", "night_share"),
    ("_is_morning", "morning_share"),
    ("_is_evening", "evening_share"),
    ("_is_small_txn", "small_txn_share"),
    ("_is_large_txn", "large_txn_share"),
]
_share_sql = ",\n         ".join(f"avg(CAST({i} AS DOUBLE)) AS {n}" for i, n in _SHARES)

CARD_AGG = f"""
card_agg AS (
  SELECT card_number,
         CAST(max(label) AS TINYINT) AS label,
         count(*) AS total_transactions,
         sum({_AMT}) AS total_amount,
         avg({_AMT}) AS avg_amount,
         median({_AMT}) AS median_amount,
         max(CASE WHEN isnan({_AMT}) THEN NULL ELSE {_AMT} END) AS max_amount,
         stddev_samp({_AMT}) AS std_amount,
         count(DISTINCT transaction_date) AS active_days,
         count(DISTINCT merchant_id) AS unique_merchants,
         count(DISTINCT mcc) AS unique_mcc,
         count(DISTINCT country) AS unique_countries,
         count(DISTINCT merchant_country) AS unique_merchant_countries,
         {_share_sql}
  FROM ind GROUP BY card_number
),
card_feat AS (
  SELECT card_number, label, total_transactions,
         coalesce(total_amount, 0.0) AS total_amount,
         coalesce(avg_amount, 0.0) AS avg_amount,
         coalesce(median_amount, 0.0) AS median_amount,
         coalesce(max_amount, 0.0) AS max_amount,
         coalesce(std_amount, 0.0) AS std_amount,
         active_days, unique_merchants, unique_mcc, unique_countries, unique_merchant_countries,
         {", ".join(f"coalesce({n}, 0.0) AS {n}" for _, n in _SHARES)},
         CASE WHEN active_days > 0 THEN CAST(total_transactions AS DOUBLE) / active_days ELSE 0.0 END
           AS transactions_per_active_day,
         CASE WHEN total_transactions > 0 THEN CAST(unique_merchants AS DOUBLE) / total_transactions
           ELSE 0.0 END AS merchant_diversity_ratio,
         CASE WHEN total_transactions > 0 THEN CAST(unique_mcc AS DOUBLE) / total_transactions
           ELSE 0.0 END AS mcc_diversity_ratio,
         coalesce(CASE WHEN abs(avg_amount) > 0 THEN std_amount / abs(avg_amount) ELSE 0.0 END, 0.0)
           AS amount_cv
  FROM card_agg
)"""

BASE_CTES = [RAW_TXN, CLEAN_TXN, MERCHANTS, ENRICHED, INDICATORS, CARD_AGG]

# high-volume source: one transaction per order line
VOLUME_CLEAN_TXN = f"""
vol_raw AS (
  SELECT o.o_custkey AS card_number, l.l_extendedprice AS transaction_amount_kzt,
         l.l_suppkey AS merchant_id, regexp_extract(p.p_brand, '[0-9]+', 0) AS mcc,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'online' ELSE 'offline' END AS channel,
         l.l_shipdate AS ship, c.c_nationkey AS country,
         l.l_returnflag = 'R' AS tokenized, l.l_linestatus = 'O' AS Is_recurring,
         coalesce(c.c_mktsegment IN {_in(BUSINESS_SEGMENTS)}, false) AS is_business
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
),
clean_txn AS (
  SELECT CAST(card_number AS VARCHAR) AS card_number,
         CAST(transaction_amount_kzt AS DOUBLE) AS transaction_amount_kzt,
         CAST(merchant_id AS VARCHAR) AS merchant_id, mcc,
         coalesce(lower(channel), 'unknown') AS channel,
         CAST(country AS VARCHAR) AS country,
         coalesce(tokenized, false) AS tokenized, coalesce(Is_recurring, false) AS Is_recurring,
         CAST(ship AS DATE) AS transaction_date, CAST(ship AS TIMESTAMP) AS transaction_timestamp,
         CAST(ship AS TIMESTAMP) AS transaction_datetime,
         CAST(CASE WHEN is_business THEN 1 ELSE 0 END AS TINYINT) AS label
  FROM vol_raw WHERE card_number IS NOT NULL AND transaction_amount_kzt IS NOT NULL
)"""
VOLUME_CTES = [VOLUME_CLEAN_TXN, MERCHANTS, ENRICHED, INDICATORS, CARD_AGG]


def with_ctes(select: str, extra: list[str] | None = None, base: list[str] | None = None) -> str:
    ctes = list(BASE_CTES if base is None else base) + list(extra or [])
    return "WITH " + ",".join(c.strip("\n") for c in ctes) + "\n" + select


__all__ = ["with_ctes", "BUSINESS_SEGMENTS"]
