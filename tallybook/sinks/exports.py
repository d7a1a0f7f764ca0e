"""CSV exports, one folder for each profile, all profiles in one pass."""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.money import money_text
from tallybook.operators.rollups import spend_only
from tallybook.sources.lake import unsorted_writes

# Columns of the exported files.
TRANSACTION_COLUMNS = (
    "profile_id", "txn_id", "account_id", "post_date", "amount", "currency", "name", "clean_desc", "merchant",
    "category", "subcategory", "operation", "is_transfer",
)
MONTHLY_COLUMNS = ("profile_id", "year", "month", "category", "subcategory", "total_amount")
SPEND_COLUMNS = ("profile_id", "year", "month", "category", "subcategory", "spend")
SHARE_COLUMNS = ("owner_profile_id", "viewer_profile_id")


# From so many rows for each profile on, facts are exported as they lie. That is some files of 100 MB in any case.
LARGE_PROFILE = 10_000_000


def write_csv_by_profile(df: DataFrame, path: str, regroup: bool = True) -> None:
    """Write ``path/profile=<id>/*.csv`` with header.

    A profile becomes one file, unless it is so large that adaptive execution splits it over several tasks. Without
    ``regroup`` there is no exchange, and each task writes a file for each profile it has rows of.
    Amounts are written with all their digits, e.g. ``-850.0``.
    """
    money = [f.name for f in df.schema if f.dataType.typeName() == "decimal"]
    rows = df.withColumns({c: money_text(F.col(c)) for c in money}).withColumn("profile", F.col("profile_id"))
    rows = rows.hint("rebalance", "profile") if regroup else rows
    with nullcontext() if regroup else unsorted_writes(df.sparkSession):
        rows.write.mode("overwrite").partitionBy("profile").option("header", True).csv(path)


def export_transactions(fact: DataFrame, path: str, large: int = LARGE_PROFILE) -> None:
    """Profiles of at least ``large`` rows on average are written from the folders they lie in; smaller ones are brought together."""
    held = fact.groupBy("profile_id").agg(F.count(F.lit(1)).alias("n")).agg(F.avg("n")).first()[0]
    write_csv_by_profile(fact.select(*TRANSACTION_COLUMNS), path, regroup=held is None or held < large)


def export_category_monthly(monthly: DataFrame, path: str) -> None:
    write_csv_by_profile(monthly.select(*MONTHLY_COLUMNS), path)


def export_spend_only(monthly: DataFrame, path: str) -> None:
    write_csv_by_profile(spend_only(monthly).select(*SPEND_COLUMNS), path)


def export_share_index(shares: DataFrame, path: str) -> None:
    shares.select(*SHARE_COLUMNS).write.mode("overwrite").option("header", True).csv(path)


def export_all(fact: DataFrame, monthly: DataFrame, root: str) -> None:
    export_transactions(fact, f"{root}/transactions")
    export_category_monthly(monthly, f"{root}/category_monthly")
    export_spend_only(monthly, f"{root}/category_spend_only")
