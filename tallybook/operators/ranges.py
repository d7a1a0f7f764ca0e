"""Date ranges of reports: presets, bounds of the data, calendar.

``as_of`` stands for today. Left out, the newest date of the data takes its place, so a report over the same
data gives the same result on any day.

Bounds of facts come from the facts themselves or, with ``folders``, from the statistics that are kept for each of their
folders (``sources/folders.py``), restricted in the same way as the facts: then no data file is opened for them.
"""

from __future__ import annotations

import calendar
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRESETS = ("7d", "30d", "mtd", "qtd", "ytd", "all", "default")


def _folder(df: DataFrame) -> Column:
    return F.col("year") * 12 + F.col("month")


def date_bounds(facts: DataFrame, foldered: bool = False, folders: DataFrame | None = None) -> DataFrame:
    """One row: min_date, max_date.

    ``folders`` are the statistics of the facts' folders. Without them, ``foldered`` says that facts are read from a lake table with year and month folders. Then the outermost
    months are found from the folders, and only their files are read for the days.
    """
    if folders is not None:
        return folders.agg(F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date"))
    if foldered:
        months = facts.agg(F.struct(F.min(_folder(facts)).alias("lo"), F.max(_folder(facts)).alias("hi"))).scalar()
        facts = facts.filter((_folder(facts) == months["lo"]) | (_folder(facts) == months["hi"]))
    return facts.agg(F.min("post_date").alias("min_date"), F.max("post_date").alias("max_date"))


def preset_range(
    facts: DataFrame, preset: str, as_of: date | None = None, foldered: bool = False, folders: DataFrame | None = None
) -> DataFrame:
    """One row: from_date, to_date of a preset over these facts."""
    newest = F.col("max_date")
    anchor = newest if as_of is None else F.least(newest, F.lit(as_of))
    ranges: dict[str, tuple[Column, Column]] = {
        "7d": (F.date_sub(anchor, 6), anchor),
        "30d": (F.date_sub(anchor, 29), anchor),
        "mtd": (F.trunc(anchor, "MM"), anchor),
        "qtd": (F.trunc(anchor, "QUARTER"), anchor),
        "ytd": (F.trunc(anchor, "YEAR"), anchor),
        "all": (F.col("min_date"), newest),
        "default": (F.trunc(newest, "MM"), F.last_day(newest)),
    }
    if preset not in ranges:
        raise ValueError(f"unknown preset {preset!r}; known are {', '.join(PRESETS)}")
    start, end = ranges[preset]
    return date_bounds(facts, foldered, folders).select(start.alias("from_date"), end.alias("to_date"))


def _month_number(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def between_days(facts: DataFrame, start: Column, end: Column) -> DataFrame:
    """Rows dated from start to end, both included. Month folders outside the range are not read."""
    kept = facts.filter(F.col("post_date").between(start, end))
    if {"year", "month"} <= set(facts.columns):
        kept = kept.filter(_folder(facts).between(_month_number(start), _month_number(end)))
    return kept


def in_preset(
    facts: DataFrame, preset: str, as_of: date | None = None, foldered: bool = False, folders: DataFrame | None = None
) -> DataFrame:
    """Rows in a preset range. The range is a scalar subquery, so the report stays one lazy plan."""
    days = preset_range(facts, preset, as_of, foldered, folders).select(F.struct("from_date", "to_date")).scalar()
    return between_days(facts, days["from_date"], days["to_date"])


def in_custom(facts: DataFrame, start: date, end: date) -> DataFrame:
    return between_days(facts, F.lit(start), F.lit(end))


def in_month(facts: DataFrame, year: int, month: int) -> DataFrame:
    return in_custom(facts, date(year, month, 1), date(year, month, calendar.monthrange(year, month)[1]))


def month_of_range(start: date, end: date) -> str | None:
    """``YYYY-MM`` if the range lies in one month, else None."""
    return f"{start:%Y-%m}" if (start.year, start.month) == (end.year, end.month) else None


def calendar_months(facts: DataFrame, foldered: bool = False, folders: DataFrame | None = None) -> DataFrame:
    """Every month of the years the data covers, with a flag for months wholly outside it."""
    first = F.explode(
        F.sequence(
            F.trunc("min_date", "YEAR"),
            F.add_months(F.trunc("max_date", "YEAR"), 11),
            F.expr("INTERVAL 1 MONTH"),
        )
    )
    months = date_bounds(facts, foldered, folders).select("min_date", "max_date", first.alias("first_day"))
    last = F.last_day("first_day")
    return months.select(
        F.year("first_day").alias("year"),
        F.month("first_day").alias("month"),
        "first_day",
        last.alias("last_day"),
        ((last < F.col("min_date")) | (F.col("first_day") > F.col("max_date"))).alias("is_disabled"),
    )
