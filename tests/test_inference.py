"""Column-wide format inference: votes, winners, the rest, and what no format parses."""

import datetime as dt
import re

from pyspark.sql import functions as F

from cardlens.functions import inference
from cardlens.operators.clean import normalize_transactions

D = dt.datetime


def parsed(spark, texts, kind="timestamp"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = inference.parse_inferred(df, {"v": ("t", kind)}).orderBy("i").collect()
    return [r.v for r in rows], rows[0].v_format, rows[0].v_share


def test_every_format(spark):
    cases = {
        "year-month-day": ["2024-03-05 07:08:09.123456789", "2024.03.05T07:08"],
        "day-month-year": ["25/03/2024 07:08"],
        "month-day-year": ["03/25/2024"],
        "yearmonthday": ["20240325", "20240325 10:11:12"],
        "day month-name year": ["5 March 2024 12:00 AM", "05-Mar-2024"],
        "month-name day year": ["Mar 5, 2024, 1:02 PM", "march 05 2024"],
        "day month-name short-year": ["05-Mar-24", "5 mar 70"],
        "day-month-short-year": ["25.03.24", "25/03/69 10:00"],
        "month-day-short-year": ["03/25/68"],
    }
    want = {
        "year-month-day": [D(2024, 3, 5, 7, 8, 9, 123456), D(2024, 3, 5, 7, 8)],
        "day-month-year": [D(2024, 3, 25, 7, 8)],
        "month-day-year": [D(2024, 3, 25)],
        "yearmonthday": [D(2024, 3, 25), D(2024, 3, 25, 10, 11, 12)],
        "day month-name year": [D(2024, 3, 5), D(2024, 3, 5)],
        "month-name day year": [D(2024, 3, 5, 13, 2), D(2024, 3, 5)],
        "day month-name short-year": [D(2024, 3, 5), D(1970, 3, 5)],
        "day-month-short-year": [D(2024, 3, 25), D(1969, 3, 25, 10)],
        "month-day-short-year": [D(2068, 3, 25)],
    }
    for name, texts in cases.items():
        assert parsed(spark, texts) == (want[name], name, 1.0), name


def test_the_column_decides_between_day_and_month(spark):
    values, name, share = parsed(spark, ["03/04/2024", "03/25/2024", None, "04/05/2024"], "date")
    assert name == "month-day-year" and share == 1.0
    assert values == [dt.date(2024, 3, 4), dt.date(2024, 3, 25), None, dt.date(2024, 4, 5)]
    values, name, _ = parsed(spark, ["03/04/2024", "04/05/2024"], "date")
    assert name == "day-month-year" and values[0] == dt.date(2024, 4, 3)  # equal votes: the one listed first


def test_the_rest_goes_to_other_voted_formats(spark):
    texts = ["5 Jan 2024 01:00 PM"] * 3 + ["2024-02-30", "2024-02-29", "n/a", "", None, "32 Jan 2024", "5 Jan 2024 13:00 PM"]
    values, name, share = parsed(spark, texts)
    assert name == "day month-name year" and abs(share - 3 / 9) < 1e-12
    assert values == [D(2024, 1, 5, 13)] * 3 + [None, D(2024, 2, 29)] + [None] * 5


def test_offsets_are_taken_off_in_any_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            values, *_ = parsed(spark, ["2024-03-10 02:30:00", "2024-01-01 00:30+05:00", "2024-01-01T00:30Z", "2024-01-01 00:30-0130"])
            assert values == [D(2024, 3, 10, 2, 30), D(2023, 12, 31, 19, 30), D(2024, 1, 1, 0, 30), D(2024, 1, 1, 2, 0)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_nothing_to_infer(spark):
    assert parsed(spark, [None, "x"]) == ([None, None], None, 0.0)
    df = spark.createDataFrame([], "i int, t string")
    assert inference.parse_inferred(df, {"v": ("t", "date")}).count() == 0


def test_short_parser(spark):
    """Formats without a vote are not in the plan, and the stage is small enough to be compiled."""
    df = spark.createDataFrame([("03/25/2024",)] * 5, "t string").repartition(2)
    out = inference.parse_inferred(df, {"v": ("t", "timestamp")}).select("v")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)) < 8000
    assert "jan|feb" not in text


def test_cleaning_with_inferred_dates(spark):
    raw = spark.createDataFrame(
        [("c1", "1.5", "m", "Mar 5, 2024", "5 Mar 24 01:00 PM"), ("c2", "2", "m", None, None)],
        "card_number string, transaction_amount_kzt string, merchant_id string, transaction_date string, transaction_timestamp string",
    )
    fixed = normalize_transactions(raw).filter(F.col("card_number") == "c1").first()
    assert fixed.transaction_date is None and fixed.transaction_timestamp is None
    row = normalize_transactions(raw, infer_datetimes=True).filter(F.col("card_number") == "c1").first()
    assert (row.transaction_date, row.transaction_timestamp) == (dt.date(2024, 3, 5), D(2024, 3, 5, 13))
