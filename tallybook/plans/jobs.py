"""The jobs of the ledger, each a function over lake folders."""

from __future__ import annotations

from typing import Any

from pyspark.sql import SparkSession

from tallybook.operators.first_match import categorize
from tallybook.operators.standardize import dealt, dedup_transactions, standardize
from tallybook.plans.incremental import refresh, write_gold
from tallybook.sinks.exports import export_all
from tallybook.sources.lake import (
    Lake,
    read_bronze,
    read_fact,
    read_monthly,
    read_silver,
    write_table,
)
from tallybook.sources.rules import load_simple_rules
from tallybook.streaming.inbox_stream import ingest_inbox


def build_silver(spark: SparkSession, lake: Lake, fmt: str = "parquet") -> None:
    """Bronze to silver, whole table. One exchange brings both copies and the rows of a folder together."""
    bronze = dealt(read_bronze(spark, lake, fmt))
    write_table(dedup_transactions(standardize(bronze)), lake.silver, fmt=fmt, regroup=False)


def build_categorized(
    spark: SparkSession, lake: Lake, rules: list[dict[str, Any]], fmt: str = "parquet"
) -> None:
    """Silver to its own labelled table. Silver stays as it is, so changed rules can be run again.

    Same folders as silver, so the job has no exchange.
    """
    write_table(categorize(read_silver(spark, lake, fmt), rules), lake.categorized, fmt=fmt, regroup=False)


def build_gold(spark: SparkSession, lake: Lake, fmt: str = "parquet") -> None:
    """Labelled table to facts, monthly totals and folder statistics, whole tables."""
    write_gold(spark, lake, fmt)


def build_exports(spark: SparkSession, lake: Lake, out: str, fmt: str = "parquet") -> None:
    export_all(read_fact(spark, lake, fmt), read_monthly(spark, lake, fmt), out)


def run_all(
    spark: SparkSession,
    inbox: str,
    lake: Lake,
    rules_dir: str,
    out: str,
    checkpoint: str,
    archive: str | None = None,
) -> None:
    """Inbox to CSV exports. Only folders that new statements fall into are built anew; changed rules label all of them."""
    ingest_inbox(spark, inbox, lake, checkpoint, archive).awaitTermination()
    refresh(spark, lake, load_simple_rules(spark, rules_dir))
    build_exports(spark, lake, out)
