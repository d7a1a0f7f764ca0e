"""Statement dates in the many spellings banks use, without a Python function per row.

The reading order is the one a year-first, then month-first, then day-first reader would use:

* three numbers ``a b c`` are year-month-day when ``a`` can only be a year, or when ``b`` and ``c`` could
  be a month and a day; otherwise day-month-year when ``a`` cannot be a month; otherwise month-day-year;
* a value that gives no real calendar date that way is read again day-first;
* month names fix the month, and the two numbers are split into day and year by the same idea;
* anything that does not name a full date (``5 Jan``) is NULL, since its year would depend on today.

ISO dates, nearly all of a clean feed, take a single regular expression and one cast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Two-digit years from here on belong to the 1900s, smaller ones to the 2000s.
CENTURY_PIVOT = 76

# Date spellings understood by the reader.
PLAIN_NUMBERS = r"^\d{1,4}[-/. ]\d{1,2}[-/. ]\d{1,4}$"
ISO_DAY = r"^\s*(\d{4}-\d{1,2}-\d{1,2})(?:[Tt\s]\s*\d{1,2}:\d{2}.*)?\s*$"
CLOCK = (
    r"(?:\bt|(?<=\d)t)?\b\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?\s*(?:[ap]\.?m\.?)?\s*"
    r"(?:\bz\b|(?<=\d)z\b|\butc\b|\bgmt\b|[+-]\d{2}:?\d{2}\b)?"
)
COMPACT_CLOCK = r"(?<=\d{8})(?:t?\d{4}(?:\d{2})?)$"
NOISE = r"\b(?:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?\b|(?<=\d)(?:st|nd|rd|th)\b|\bof\b"
COMPACT_DAY = r"^(\d{4}|\d{2})(\d{2})(\d{2})$"
MONTH_NAME = (
    r"^(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?"
    r"|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)$"
)
MONTH_STARTS = "janfebmaraprmayjunjulaugsepoctnovdec"


def _iso(text: Column) -> Column:
    day = F.regexp_extract(text, ISO_DAY, 1)
    return F.nullif(day, F.lit("")).try_cast("date")


def _dashed(text: Column) -> Column:
    """Lower-case ``a-b-c`` form of a date text: clock, weekday and ordinal endings gone."""
    t = F.lower(F.trim(text))
    t = F.when(text.contains(":"), F.regexp_replace(t, CLOCK, " ")).otherwise(t)
    t = F.regexp_replace(t, COMPACT_CLOCK, "")
    t = F.regexp_replace(t, NOISE, " ")
    t = F.regexp_replace(t, r"(?<=\d)(?=[a-z])|(?<=[a-z])(?=\d)", "-")
    t = F.regexp_replace(t, r"[-/.,\s]+", "-")
    t = F.regexp_replace(t, r"^-|-$", "")
    return F.regexp_replace(t, COMPACT_DAY, "$1-$2-$3")


def _day(year: Column, month: Column, day: Column, pivot: int) -> Column:
    """DATE from three number texts; NULL where they name no calendar day."""
    short = F.length(year) <= 2
    full = F.when(
        short, F.when(year.try_cast("int") >= pivot, F.lit(1900)).otherwise(F.lit(2000)) + year.try_cast("int")
    ).otherwise(year.try_cast("int"))
    return F.concat_ws("-", F.lpad(full.cast("string"), 4, "0"), month, day).try_cast("date")


def with_parsed_date(
    df: DataFrame, source: str, target: str, century_pivot: int = CENTURY_PIVOT
) -> DataFrame:
    """Add (or replace) ``target`` with the DATE read from the text column ``source``.

    Three narrow projections, so that each intermediate text is computed once for a row; rows with an ISO
    date skip the rest of the work because the later steps see NULL.
    """
    iso, parts = "__iso", "__parts"
    kept = [F.col(f"`{c}`") for c in df.columns]

    step = df.select(*kept, _iso(F.col(source)).alias(iso))
    text = F.col(source)
    pieces = F.when(F.trim(text).rlike(PLAIN_NUMBERS), F.split(F.trim(text), "[-/. ]")).otherwise(
        F.split(_dashed(text), "-")
    )
    step = step.select("*", F.when(F.col(iso).isNull(), pieces).alias(parts))

    a, b, c = (F.get(F.col(parts), F.lit(i)) for i in range(3))
    is_name = [t.rlike(MONTH_NAME) for t in (a, b, c)]
    is_num = [t.rlike(r"^\d{1,4}$") for t in (a, b, c)]
    num = [t.try_cast("int") for t in (a, b, c)]

    def month_no(t: Column) -> Column:
        place = F.instr(F.lit(MONTH_STARTS), F.substring(t, 1, 3))
        return ((place + F.lit(2)) / F.lit(3)).cast("int").cast("string")

    def long(t: Column) -> Column:
        return F.length(t) >= 3

    def ymd(y: Column, m: Column, d: Column) -> Column:
        return _day(y, m, d, century_pivot)

    numeric = (
        F.when(
            long(a) | (num[0] > 31), F.coalesce(ymd(a, b, c), ymd(a, c, b))
        )
        .when((num[1] <= 12) & (num[2] <= 31), F.coalesce(ymd(a, b, c), ymd(c, b, a)))
        .when(num[0] > 12, ymd(c, b, a))
        .otherwise(ymd(c, a, b))
    )
    name_first = F.when(long(b) | (num[1] > 31), ymd(b, month_no(a), c)).otherwise(ymd(c, month_no(a), b))
    name_middle = (
        F.when(long(c), ymd(c, month_no(b), a))
        .when(long(a) | (num[0] > 31), ymd(a, month_no(b), c))
        .when(num[2] <= 31, F.coalesce(ymd(a, month_no(b), c), ymd(c, month_no(b), a)))
        .otherwise(ymd(c, month_no(b), a))
    )
    name_last = F.when(long(b) | (num[1] > 31), ymd(b, month_no(c), a)).otherwise(ymd(a, month_no(c), b))

    read = (
        F.when(F.col(iso).isNotNull(), F.col(iso))
        .when(F.coalesce(F.size(parts), F.lit(0)) != 3, F.lit(None).cast("date"))
        .when(is_num[0] & is_num[1] & is_num[2], numeric)
        .when(is_name[0] & is_num[1] & is_num[2], name_first)
        .when(is_num[0] & is_name[1] & is_num[2], name_middle)
        .when(is_num[0] & is_num[1] & is_name[2], name_last)
    )
    out = [F.col(f"`{c}`") for c in df.columns if c != target]
    return step.select(*out, read.alias(target))
