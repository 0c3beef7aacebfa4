"""Lenient, type-dispatched column parsers.

Every builder takes the DataFrame's field type at plan time and returns a
plain ``Column`` made of built-in functions only (whole-stage codegen, no
Python UDF). A value that cannot be parsed becomes null — never an error,
even with ANSI mode on: string inputs are gated by a full-match regex before
any cast, so no cast is ever attempted on text it would reject.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlens.config import FALSEY_VALUES, TRUTHY_VALUES

# Numeric text accepted by the double parser: no surrounding spaces and no
# Java suffixes such as "1.5d" (Spark's own cast would accept both).
NUMERIC_TEXT_RE = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER_TEXT_RE = r"^[+-]?[0-9]+$"

# Date / datetime text: year-first (2024-01-06, 2024/01/06, 2024.01.06) and
# day-first (06-01-2024, 06/01/2024, 06.01.2024), optionally followed by a time
# "HH:mm[:ss[.f]]" (1 to 9 fraction digits, cut to microseconds) after a space or
# "T", and that by "Z" or an offset, which is taken off (UTC). Separators must
# agree. Dates may also be eight digits (20240106).
DATETIME_RE = (
    r"^(?:(?:[0-9]{4}([-/.])[0-9]{2}\1[0-9]{2}|[0-9]{2}([-/.])[0-9]{2}\2[0-9]{4})"
    r"(?:[ T][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,9})?)?(?:Z|[+-](?:0[0-9]|1[0-8]):?[0-5][0-9])?)?"
    r"|[0-9]{8})$"
)
# the date of such a text, whichever way round, and its year-first form
DATE_PART_RE = r"^(?:([0-9]{2})[-/.]([0-9]{2})[-/.]([0-9]{4})|([0-9]{4})[-/.]?([0-9]{2})[-/.]?([0-9]{2}))"
YEAR_FIRST = "$3$4-$2$5-$1$6"
ZONE_RE = r":[0-9.]+(?:Z|[+-][0-9:]+)$"


def _field_type(df, name: str) -> T.DataType:
    return df.schema[name].dataType


def _is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def to_text(col: Column) -> Column:
    """Lenient cast to string (every type has a string form)."""
    return col.cast("string")


def text_expr(df, name: str) -> Column:
    return to_text(F.col(name))


def double_expr(df, name: str) -> Column:
    """Lenient cast to double; unparsable text -> null."""
    dtype = _field_type(df, name)
    c = F.col(name)
    if isinstance(dtype, T.StringType):
        low = F.lower(c)
        return (
            F.when(c.rlike(NUMERIC_TEXT_RE), c.try_cast("double"))
            .when(low.isin("nan", "+nan", "-nan"), F.lit(float("nan")))
            .when(low.isin("inf", "+inf", "infinity", "+infinity"), F.lit(float("inf")))
            .when(low.isin("-inf", "-infinity"), F.lit(float("-inf")))
        )
    if _is_numeric(dtype):
        return c.cast("double")
    if isinstance(dtype, T.BooleanType):
        return c.cast("double")
    return F.lit(None).cast("double")


def bool_expr(df, name: str) -> Column:
    """Multi-format flag -> boolean, never null.

    Text is lower-cased but not trimmed. A FALSEY word wins; otherwise the flag
    is true when the value is a TRUTHY word, an integer literal equal to 1, or a
    non-zero number / true boolean. Anything else (including null) is false.
    """
    dtype = _field_type(df, name)
    c = F.col(name)
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    if _is_numeric(dtype):
        return F.coalesce(c != 0, F.lit(False))
    text = F.lower(c.cast("string"))
    as_int_one = F.when(c.rlike(INTEGER_TEXT_RE), c.try_cast("decimal(38,0)") == 1)
    parsed = text.isin(*TRUTHY_VALUES) | F.coalesce(as_int_one, F.lit(False))
    return F.when(text.isin(*FALSEY_VALUES), F.lit(False)).otherwise(
        F.coalesce(parsed, F.lit(False))
    )


def since_epoch(micros: Column) -> Column:
    """Microseconds since the epoch -> TIMESTAMP_NTZ in UTC, whatever the session's zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", micros.cast("long"), epoch)


def with_seconds(iso: Column) -> Column:
    """An offset right after the minutes needs seconds before it to be cast."""
    return F.regexp_replace(iso, "([ T][0-9]{1,2}:[0-9]{2})([-+Z])", "$1:00$2")


def datetime_from_text(c: Column) -> Column:
    """Text -> TIMESTAMP_NTZ, null where it has no accepted form or names no date or
    time that exists. One gate, one rewrite of the date, one cast: few enough
    instructions that a stage with several such columns is still compiled."""
    iso = F.regexp_replace(c, DATE_PART_RE, YEAR_FIRST)
    zoned = since_epoch(F.unix_micros(with_seconds(iso).try_cast("timestamp")))
    plain = iso.try_cast("timestamp_ntz")
    return F.when(c.rlike(DATETIME_RE), F.when(c.rlike(ZONE_RE), zoned).otherwise(plain))


def with_parsed_datetimes(df, specs: dict[str, tuple[str, str]]):
    """Add/replace columns ``out -> (source column, "date" | "timestamp")``."""
    built = {"date": date_expr, "timestamp": timestamp_expr}
    return df.withColumns({out: built[kind](df, src) for out, (src, kind) in specs.items()})


def timestamp_expr(df, name: str) -> Column:
    """Multi-format value -> TIMESTAMP_NTZ (dates become midnight)."""
    dtype = _field_type(df, name)
    c = F.col(name)
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp_ntz")
    if isinstance(dtype, T.TimestampType):
        return since_epoch(F.unix_micros(c))
    if isinstance(dtype, T.StringType):
        return datetime_from_text(c)
    if isinstance(dtype, T.IntegralType):
        # integers are microseconds since the epoch
        return since_epoch(c)
    return F.lit(None).cast("timestamp_ntz")


def date_expr(df, name: str) -> Column:
    """Multi-format value -> DATE (datetimes keep their date part)."""
    dtype = _field_type(df, name)
    c = F.col(name)
    if isinstance(dtype, T.DateType):
        return c
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        return F.to_date(timestamp_expr(df, name))
    if isinstance(dtype, T.StringType):
        return F.to_date(datetime_from_text(c))
    if isinstance(dtype, T.IntegralType):
        # integers are days since the epoch
        return F.date_from_unix_date(c.cast("int"))
    return F.lit(None).cast("date")


def iso_weekday(d: Column) -> Column:
    """ISO weekday, Monday=1 .. Sunday=7."""
    return F.weekday(d) + 1


def guarded_ratio(num: Column, den: Column, when_positive: Column | None = None) -> Column:
    """num / den when the guard holds (default den > 0), else 0.0."""
    guard = den > 0 if when_positive is None else when_positive
    return F.when(guard, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))
