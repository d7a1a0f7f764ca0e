"""Rows behind a category or a day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.text import UNCATEGORIZED, first_filled, or_dash
from tallybook.operators.ranges import in_custom


def in_category(facts: DataFrame, label: str) -> DataFrame:
    """Rows of a category as reports name it, so ``Uncategorized`` finds the rows without one."""
    named = F.col("category") == label
    # Written so that the scan can take it: a comparison of the label itself reaches no file.
    return facts.filter(F.col("category").isNull() | named if label == UNCATEGORIZED else named)


def on_day(facts: DataFrame, day: date) -> DataFrame:
    """Rows of a day; only its month's folders are read."""
    return in_custom(facts, day, day)


def detail_rows(facts: DataFrame) -> DataFrame:
    """The table of a drilldown, newest first."""
    names = [F.col(c) for c in ("name", "clean_desc", "description") if c in facts.columns]
    return facts.select(
        "post_date",
        first_filled(*names).alias("label"),
        or_dash(F.col("category")).alias("category"),
        or_dash(F.col("merchant")).alias("merchant"),
        "amount",
        "txn_id",
    ).orderBy(F.desc("post_date"), "txn_id")
