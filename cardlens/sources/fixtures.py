"""Adapters from the benchmark tables to the card pipeline's raw sources.

The pipeline expects two raw transaction tables (business cards, consumer
cards) and a merchant reference. These adapters derive them, lazily and
row-for-row, from the given tables so every query's work grows with them:

* ``events``            -> transactions (has time of day), split into the two
                           segments by card; raw columns deliberately come in
                           mixed formats to drive the cleaning stage;
* ``supplier ⋈ nation`` -> merchant reference, plus alternate rows for
                           suppliers with a negative balance (conflicting
                           duplicates for the keep-first dedup);
* ``lineitem ⋈ orders ⋈ customer ⋈ part`` -> a high-volume transaction source;
* ``customer``          -> a scored frame (label, probability) for evaluation.

The same mapping is written in DuckDB SQL in ``cardlens.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.config import MCC_RESTAURANT, MCC_SUPERMARKET, MCC_TAXI, TOP20_MCC
from cardlens.sources.tables import table

# fixture values: raw flag texts cycled by event id (drive the flag parser)
FLAG_TEXTS = ("1", "TRUE", "t", "Yes", "0", "no", " yes ", None)
# raw channel text per event type; "error" events carry no channel
CHANNEL_TEXT = {"click": "ONLINE", "view": "online", "purchase": "Offline", "signup": "offline"}
# customer segments treated as business cards in the volume source
BUSINESS_SEGMENTS = ("BUILDING", "MACHINERY")


def _sql_text(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def _cycle_sql(index: str, values) -> str:
    """The text at an index of ``values``: a lookup in a constant array."""
    return f"get(array({', '.join(map(_sql_text, values))}), CAST({index} AS INT))"


def _event_mcc_sql(k: str) -> str:
    """Integer MCC from the event's props key: household codes, else a top-20 code."""
    household = {0: MCC_SUPERMARKET, 1: MCC_RESTAURANT, 2: MCC_TAXI}
    codes = [str(int(household.get(i % 10, code))) for i, code in enumerate(TOP20_MCC)]
    return f"get(array({', '.join(codes)}), {k} % {len(codes)})"


_CHANNEL_SQL = "CASE event_type " + " ".join(
    f"WHEN {_sql_text(ev)} THEN {_sql_text(t)}" for ev, t in CHANNEL_TEXT.items()
) + " END"

# one Spark SQL expression per raw column (parsed once on the JVM)
_EVENT_COLUMNS = [
    "event_id AS transaction_id",
    "user_id AS card_number",
    "value * 200 AS transaction_amount_kzt",
    "CASE WHEN event_type <> 'error' THEN regexp_extract(props, '[0-9]+', 0) END AS merchant_id",
    _event_mcc_sql("try_cast(regexp_extract(props, '[0-9]+', 0) AS INT)") + " AS mcc",
    _CHANNEL_SQL + " AS channel",
    "CASE WHEN event_id % 3 = 0 THEN date_format(ts, 'dd/MM/yyyy') "
    "WHEN event_id % 12 = 4 THEN date_format(ts, 'yyyyMMdd') "
    "ELSE date_format(ts, 'yyyy-MM-dd') END AS transaction_date",
    "CASE WHEN event_type <> 'error' THEN CASE WHEN event_id % 2 = 0 "
    "THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss') "
    "WHEN event_id % 10 = 1 THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") "
    "WHEN event_id % 10 = 3 THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'000+05:00'\") "
    "ELSE date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") END END AS transaction_timestamp",
    "CASE WHEN event_id % 11 <> 0 THEN concat('C', CAST(user_id % 7 AS STRING)) END AS country",
    _cycle_sql("event_id % 8", FLAG_TEXTS) + " AS tokenized",
    _cycle_sql("(event_id + 3) % 8", FLAG_TEXTS) + " AS Is_recurring",
    "user_id % 4 = 0 AS is_business",
]


def event_transactions(events: DataFrame) -> DataFrame:
    """Raw (uncleaned) transactions, one per event, plus ``is_business``."""
    return events.selectExpr(*_EVENT_COLUMNS)


# date texts outside the cleaning contract's fixed set, one column each, for column-wide inference:
# month names with a 12-hour clock (a tenth in another format, some unreadable), month first, two-digit years
_FOREIGN_COLUMNS = [
    "event_id AS transaction_id",
    "CASE WHEN event_id % 17 = 0 THEN 'n/a' WHEN event_id % 10 = 0 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss') "
    "ELSE date_format(ts, 'dd MMM yyyy hh:mm a') END AS named",
    "CASE WHEN event_id % 13 <> 0 THEN date_format(ts, 'MM/dd/yyyy HH:mm:ss') END AS month_first",
    "date_format(ts, 'dd.MM.yy') AS short_year",
]


def foreign_dates(events: DataFrame) -> DataFrame:
    return events.selectExpr(*_FOREIGN_COLUMNS)


def split_segments(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(business, consumer) raw frames; together they hold every row once."""
    business = raw.filter(F.col("is_business")).drop("is_business")
    consumer = raw.filter(~F.col("is_business")).drop("is_business")
    return business, consumer


def merchants_reference(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """Raw merchant reference from suppliers and their nation.

    ``nation`` is a fixed 25-row dimension, so it is broadcast.
    """
    base = supplier.join(
        F.broadcast(nation.select("n_nationkey", "n_name")),
        supplier.s_nationkey == F.col("n_nationkey"),
        "left",
    )
    main = base.select(
        F.col("s_suppkey").alias("merchant_id"),
        F.col("s_name").alias("merchant_name"),
        F.col("n_name").alias("merchant_country"),
        (F.col("s_suppkey") % 3 == 0).cast("int").alias("recurring_capable"),
        (F.col("s_nationkey") + 3000).cast("string").alias("mcc"),
    )
    alt = base.filter(F.col("s_acctbal") < 0).select(
        F.col("s_suppkey").alias("merchant_id"),
        F.concat(F.col("s_name"), F.lit(" (alt)")).alias("merchant_name"),
        F.lit(None).cast("string").alias("merchant_country"),
        (F.col("s_suppkey") % 3 != 0).cast("int").alias("recurring_capable"),
        F.lit(None).cast("string").alias("mcc"),
    )
    return main.unionByName(alt)


def volume_transactions(
    lineitem: DataFrame, orders: DataFrame, customer: DataFrame, part: DataFrame
) -> DataFrame:
    """Raw transactions from order lines (one per line item) + ``is_business``.

    Fact-to-fact join on the order key (both sides shuffle on it, or AQE picks
    a broadcast if one side is measured small), then the customer and part
    dimensions, which are joined without hints for the same reason.
    """
    li = lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag",
        "l_linestatus", "l_shipdate",
    )
    od = orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    cu = customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    pa = part.select("p_partkey", "p_brand")
    j = (
        li.join(od, li.l_orderkey == od.o_orderkey)
        .join(cu, F.col("o_custkey") == cu.c_custkey, "left")
        .join(pa, F.col("l_partkey") == pa.p_partkey, "left")
    )
    return j.select(
        F.col("o_custkey").alias("card_number"),
        F.col("l_extendedprice").alias("transaction_amount_kzt"),
        F.col("l_suppkey").alias("merchant_id"),
        F.regexp_extract("p_brand", "[0-9]+", 0).alias("mcc"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("online"))
        .otherwise(F.lit("offline"))
        .alias("channel"),
        F.col("l_shipdate").alias("transaction_date"),
        F.col("l_shipdate").alias("transaction_timestamp"),
        F.col("c_nationkey").alias("country"),
        (F.col("l_returnflag") == "R").alias("tokenized"),
        (F.col("l_linestatus") == "O").alias("Is_recurring"),
        F.coalesce(F.col("c_mktsegment").isin(*BUSINESS_SEGMENTS), F.lit(False)).alias(
            "is_business"
        ),
    )


def scored_customers(customer: DataFrame) -> DataFrame:
    """(card_number, y_true, y_proba) with many tied scores."""
    proba = F.least(F.greatest(F.round(F.col("c_acctbal") / 1000) / 10, F.lit(0.0)), F.lit(1.0))
    return customer.select(
        F.col("c_custkey").cast("string").alias("card_number"),
        F.col("c_mktsegment").isin(*BUSINESS_SEGMENTS).cast("int").alias("y_true"),
        proba.cast("double").alias("y_proba"),
    )


# -- convenience loaders over a scale-factor folder ---------------------------


def event_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    raw = event_transactions(table(spark, sf_dir, "events"))
    business, consumer = split_segments(raw)
    return {
        "business_cards": business,
        "consumer_cards": consumer,
        "merchants_reference": merchants_reference(
            table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
        ),
    }


def volume_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    raw = volume_transactions(
        table(spark, sf_dir, "lineitem"),
        table(spark, sf_dir, "orders"),
        table(spark, sf_dir, "customer"),
        table(spark, sf_dir, "part"),
    )
    business, consumer = split_segments(raw)
    return {
        "business_cards": business,
        "consumer_cards": consumer,
        "merchants_reference": merchants_reference(
            table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
        ),
    }
