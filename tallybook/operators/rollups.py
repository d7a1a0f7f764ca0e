"""Fact projection, monthly totals and the report roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybook.functions.money import outflow
from tallybook.functions.text import category_label
from tallybook.schemas import FACT

MONTH_GROUP = ("profile_id", "year", "month", "category", "subcategory")
# A share above this is labelled in charts.
LABEL_SHARE = 0.07


def fact_transactions(categorized: DataFrame) -> DataFrame:
    return categorized.select(*FACT.names)


def category_monthly(fact: DataFrame) -> DataFrame:
    """Net amount by profile, month, category and subcategory; no category is a group of its own."""
    return fact.groupBy(*MONTH_GROUP).agg(F.sum("amount").alias("total_amount"))


def spend_only(monthly: DataFrame) -> DataFrame:
    """Groups that lost money in total, as positive spend. Refunds reduce it."""
    return monthly.filter(F.col("total_amount") < 0).select(
        *MONTH_GROUP, (-F.col("total_amount")).alias("spend")
    )


def daily_spend(facts: DataFrame) -> DataFrame:
    """Outflow by day. Days with money in only stay, with 0."""
    dated = facts.filter(F.col("post_date").isNotNull())
    return dated.groupBy("post_date").agg(F.sum(outflow(F.col("amount"))).alias("spend")).orderBy("post_date")


def daily_net(facts: DataFrame) -> DataFrame:
    dated = facts.filter(F.col("post_date").isNotNull())
    return dated.groupBy("post_date").agg(F.sum("amount").alias("net")).orderBy("post_date")


def _category_totals(facts: DataFrame) -> DataFrame:
    return (
        facts.groupBy(category_label(F.col("category")).alias("category"))
        .agg(F.sum(outflow(F.col("amount"))).alias("total"))
        .filter(F.col("total") > 0)
    )


def category_spend(facts: DataFrame) -> DataFrame:
    """Outflow by category, largest first. Refunds do not reduce it."""
    return _category_totals(facts).orderBy(F.desc("total"), "category")


def category_share(facts: DataFrame) -> DataFrame:
    """Each category's part of all spend. The window runs over one row for each category."""
    share = F.col("total").cast("double") / F.sum("total").over(Window.partitionBy()).cast("double")
    return (
        _category_totals(facts)
        .select("category", "total", share.alias("share"))
        .withColumn("is_labelled", F.col("share") > LABEL_SHARE)
        .orderBy(F.desc("total"), "category")
    )


def total_spend(facts: DataFrame) -> DataFrame:
    """Outflow of all rows, 0 for none."""
    spent = F.sum(outflow(F.col("amount")))
    return facts.agg(F.coalesce(spent, F.lit(0)).alias("total_spend"))


def profiles_of(facts: DataFrame) -> DataFrame:
    return facts.select("profile_id").distinct()
