"""Column-wide inference of date and timestamp formats.

A text column usually has one format, and only the column tells which: 03/04/2024 is a
day or a month first depending on its neighbours. So a column is parsed in two steps:

1. :func:`vote` counts, in one pass over all columns asked for, how many values each known
   format parses (a format that matches but names no existing date gets no vote). One row comes back.
2. :func:`parse_inferred` parses every value with the column's winner; values that the winner
   does not parse go on to the other formats that got a vote, most votes first.
   Formats without a vote leave no trace in the plan, so that the parser stays short.

Equal votes go to the format listed first. Known are year, day or month first with four digits
or two (69-99 are 1969-1999), eight digits, month names before or after the day, each
with an optional time of 24 or 12 hours (AM/PM), fraction and offset (taken off: UTC).
A column without a parsable value has no format, share 0 and null values.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.functions.parsing import since_epoch, with_seconds

MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_NAME = "((?i:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-zA-Z]*)"
_TIME = (
    r"(?:(?:, |[ T])((?:0?[1-9]|1[0-2]):[0-5][0-9](?::[0-5][0-9])? ?(?i:am|pm)"
    r"|[0-9]{1,2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,9})?)?(?:Z|[+-](?:0[0-9]|1[0-8]):?[0-5][0-9])?))?$"
)
HALF_DAY_RE = " ?[AaPp][Mm]$"
OFFSET_RE = "(:[0-9.]+)(?:Z|[-+][0-9:]+)$"
_Y4, _Y2, _2, _12 = "([0-9]{4})", "([0-9]{2})", "([0-9]{2})", "([0-9]{1,2})"


class Format(NamedTuple):
    """A date's pattern and the groups that hold year, month and day; the time is group ``time``."""

    pattern: str
    year: int
    month: int
    day: int
    time: int = 4
    named: bool = False
    short_year: bool = False


FORMATS = {
    "year-month-day": Format(rf"^{_Y4}([-/.]){_2}\2{_2}{_TIME}", 1, 3, 4, 5),
    "day-month-year": Format(rf"^{_2}([-/.]){_2}\2{_Y4}{_TIME}", 4, 3, 1, 5),
    "month-day-year": Format(rf"^{_2}([-/.]){_2}\2{_Y4}{_TIME}", 4, 1, 3, 5),
    "yearmonthday": Format(rf"^{_Y4}{_2}{_2}{_TIME}", 1, 2, 3),
    "day month-name year": Format(rf"^{_12}[ -]{_NAME}[ -]{_Y4}{_TIME}", 3, 2, 1, named=True),
    "month-name day year": Format(rf"^{_NAME} {_12},? {_Y4}{_TIME}", 3, 1, 2, named=True),
    "day month-name short-year": Format(rf"^{_12}[ -]{_NAME}[ -]{_Y2}{_TIME}", 3, 2, 1, named=True, short_year=True),
    "day-month-short-year": Format(rf"^{_2}([-/.]){_2}\2{_Y2}{_TIME}", 4, 3, 1, 5, short_year=True),
    "month-day-short-year": Format(rf"^{_2}([-/.]){_2}\2{_Y2}{_TIME}", 4, 1, 3, 5, short_year=True),
}


def iso_text(c: Column, name: str) -> Column:
    """Text of one format with its date year first and in numbers; the time stays as it is.
    One replacement, one more for short years, one lookup for month names."""
    f = FORMATS[name]
    month = "#" if f.named else f"${f.month}"
    iso = F.regexp_replace(c, f.pattern, f"{'20' if f.short_year else ''}${f.year}-{month}-${f.day} ${f.time}")
    if f.short_year:
        iso = F.regexp_replace(iso, "^20(69|[7-9][0-9])-", "19$1-")
    if f.named:
        place = F.instr(F.lit(MONTHS), F.lower(F.substring(F.regexp_extract(c, f.pattern, f.month), 1, 3)))
        iso = F.replace(iso, F.lit("#"), F.floor((place + 2) / 3).cast("string"))
    return iso


def existing(c: Column, name: str) -> Column:
    """The ISO text if ``c`` has the format and names a date and time that exist, else null."""
    iso = iso_text(c, name)
    bare = F.regexp_replace(F.regexp_replace(iso, HALF_DAY_RE, ""), OFFSET_RE, "$1")
    return F.when(c.rlike(FORMATS[name].pattern) & bare.try_cast("timestamp_ntz").isNotNull(), iso)


def iso_value(iso: Column) -> Column:
    """TIMESTAMP_NTZ of an existing ISO text with AM/PM, an offset or neither."""
    half = F.regexp_replace(iso, HALF_DAY_RE, "").try_cast("timestamp_ntz")
    noon = F.when(F.lower(iso).endswith("pm"), 12).otherwise(0) - F.when(F.hour(half) == 12, 12).otherwise(0)
    zoned = since_epoch(F.unix_micros(with_seconds(iso).try_cast("timestamp")))
    value = F.when(iso.rlike(HALF_DAY_RE), F.timestamp_add("HOUR", noon, half))
    return value.when(iso.rlike(OFFSET_RE), zoned).otherwise(iso.try_cast("timestamp_ntz"))


class Vote(NamedTuple):
    """``formats`` with at least one value, most first; ``share`` of the first among all known values."""

    formats: list[str]
    share: float


def vote(df: DataFrame, columns: list[str]) -> dict[str, Vote]:
    """The formats of each text column: one pass, one row to the driver."""
    counts = [
        F.count(existing(F.col(c), name)).alias(f"{i}:{j}")
        for i, c in enumerate(columns)
        for j, name in enumerate(FORMATS)
    ]
    known = [F.count(F.col(c)).alias(f"{i}:n") for i, c in enumerate(columns)]
    row = df.agg(*counts, *known).first()
    out = {}
    for i, c in enumerate(columns):
        votes = sorted(((-row[f"{i}:{j}"], j, name) for j, name in enumerate(FORMATS) if row[f"{i}:{j}"]))
        out[c] = Vote([name for *_, name in votes], -votes[0][0] / row[f"{i}:n"] if votes else 0.0)
    return out


def with_voted(df: DataFrame, specs: dict[str, tuple[str, str]], found: dict[str, Vote]) -> DataFrame:
    """Add or replace ``out -> (source text column, "date" | "timestamp")``, parsed by the winner,
    else by the others that got a vote. The ISO text is a projection of its own, made once a row."""
    texts, values = {}, {}
    for out, (src, kind) in specs.items():
        tried = [existing(F.col(src), name) for name in found[src].formats]
        texts[f"_iso_{out}"] = F.coalesce(*tried) if tried else F.lit(None).cast("string")
        value = iso_value(F.col(f"_iso_{out}"))
        values[out] = F.to_date(value) if kind == "date" else value
    return df.withColumns(texts).withColumns(values).drop(*texts)


def parse_inferred(df: DataFrame, specs: dict[str, tuple[str, str]]) -> DataFrame:
    """Add ``out -> (source text column, "date" | "timestamp")`` and, per column, ``out_format`` (the
    winner, null if none) and ``out_share``."""
    found = vote(df, [src for src, _ in specs.values()])
    added = {}
    for out, (src, _) in specs.items():
        added[f"{out}_format"] = F.lit(found[src].formats[0] if found[src].formats else None).cast("string")
        added[f"{out}_share"] = F.lit(found[src].share)
    return with_voted(df, specs, found).withColumns(added)
