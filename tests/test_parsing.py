import datetime as dt
import math

from pyspark.sql import types as T

from cardlens.functions.parsing import bool_expr, date_expr, double_expr, timestamp_expr, with_parsed_datetimes


def _one_col(spark, values, dtype):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("x", dtype)])
    return spark.createDataFrame(list(enumerate(values)), schema)


def _parsed(spark, values, dtype, fn):
    df = _one_col(spark, values, dtype)
    rows = df.select("id", fn(df, "x").alias("y")).orderBy("id").collect()
    return [r["y"] for r in rows]


def test_bool_text_rules(spark):
    vals = ["1", "TRUE", "t", "Yes", "y", "0", "no", "N", " yes ", "2", "01", "+1", None, "maybe"]
    got = _parsed(spark, vals, T.StringType(), bool_expr)
    assert got == [True, True, True, True, True, False, False, False, False, False, True, True, False, False]


def test_bool_numeric_and_boolean(spark):
    assert _parsed(spark, [0, 1, 2, -1, None], T.IntegerType(), bool_expr) == [False, True, True, True, False]
    assert _parsed(spark, [True, False, None], T.BooleanType(), bool_expr) == [True, False, False]


def test_double_text_is_strict(spark):
    got = _parsed(spark, ["1.5", "-3", "1e3", ".5", "1.5d", " 3 ", "abc", None, "NaN"], T.StringType(), double_expr)
    assert got[:4] == [1.5, -3.0, 1000.0, 0.5]
    assert got[4:8] == [None, None, None, None]
    assert math.isnan(got[8])


def test_date_formats(spark):
    vals = ["2024-01-06", "2024/01/06", "06/01/2024", "06.01.2024", "2024", "bad", "2024-02-30",
            "2024-01-06 10:11:12", None]
    got = _parsed(spark, vals, T.StringType(), date_expr)
    d = dt.date(2024, 1, 6)
    assert got == [d, d, d, d, None, None, None, d, None]


def test_timestamp_formats_and_fallback(spark):
    vals = ["2024-01-06 10:11:12", "2024-01-06T10:11:12.250000", "2024-01-06", "06/01/2024 23:59", "x"]
    got = _parsed(spark, vals, T.StringType(), timestamp_expr)
    assert got == [
        dt.datetime(2024, 1, 6, 10, 11, 12),
        dt.datetime(2024, 1, 6, 10, 11, 12, 250000),
        dt.datetime(2024, 1, 6),
        dt.datetime(2024, 1, 6, 23, 59),
        None,
    ]


def test_integer_dates_are_epoch_days(spark):
    assert _parsed(spark, [0, 19728], T.IntegerType(), date_expr) == [dt.date(1970, 1, 1), dt.date(2024, 1, 6)]


def test_staged_parse_matches_single_expression(spark):
    vals = ["2024-01-06", "06/01/2024 10:00", "junk", None, "2024-13-01"]
    df = _one_col(spark, vals, T.StringType())
    staged = with_parsed_datetimes(df, {"d": ("x", "date"), "t": ("x", "timestamp")})
    single = df.select("id", date_expr(df, "x").alias("d"), timestamp_expr(df, "x").alias("t"))
    a = [(r.id, r.d, r.t) for r in staged.orderBy("id").collect()]
    b = [(r.id, r.d, r.t) for r in single.orderBy("id").collect()]
    assert a == b


def test_zones_fractions_and_compact_dates(spark):
    vals = ["2024-01-06T10:00:00Z", "2024-01-06T10:00:00+05:00", "2024-01-06 01:30:00-0330",
            "2024-01-06 10:00:00.123456789", "20240106", "2024-01-06T10:00:00+25:00", "20241301"]
    t = dt.datetime
    want = [t(2024, 1, 6, 10), t(2024, 1, 6, 5), t(2024, 1, 6, 5), t(2024, 1, 6, 10, 0, 0, 123456),
            t(2024, 1, 6), None, None]
    assert _parsed(spark, vals, T.StringType(), timestamp_expr) == want


def test_session_zone_does_not_move_times(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    seen = set()
    try:
        for zone in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.range(1).selectExpr(
                "1704535200000000 AS i", "timestamp_micros(1704583800000000) AS t", "'2024-01-06T23:30:00Z' AS s"
            )
            out = df.select(
                *(timestamp_expr(df, c).cast("string").alias(f"t_{c}") for c in df.columns),
                *(date_expr(df, c).cast("string").alias(f"d_{c}") for c in ("t", "s")),
            )
            seen.add(tuple(out.first()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert seen == {("2024-01-06 10:00:00", "2024-01-06 23:30:00", "2024-01-06 23:30:00", "2024-01-06", "2024-01-06")}


def test_offset_after_the_minutes(spark):
    from cardlens.functions.parsing import timestamp_expr

    df = spark.createDataFrame([("2024-01-01 00:30+05:00",), ("01.01.2024T00:30Z",), ("2024-01-01 00:30-0130",)], "t string")
    got = [str(r[0]) for r in df.select(timestamp_expr(df, "t")).collect()]
    assert got == ["2023-12-31 19:30:00", "2024-01-01 00:30:00", "2024-01-01 02:00:00"]
