"""Who may see whose transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def share_index(profiles: DataFrame) -> DataFrame:
    """Pairs (owner, viewer): every profile sees itself and shares with the viewers it lists."""
    viewers = F.concat(F.array("id"), F.coalesce("share_with", F.array().cast("array<string>")))
    return profiles.select(F.col("id").alias("owner_profile_id"), F.explode(viewers).alias("viewer_profile_id"))


def default_owners(profiles: DataFrame, order: str) -> DataFrame:
    """For each viewer the owner shown first: the first in the order of profiles."""
    viewers = F.concat(F.array("id"), F.coalesce("share_with", F.array().cast("array<string>")))
    pairs = profiles.select(F.col(order).alias("__at"), "id", F.explode(viewers).alias("viewer_profile_id"))
    return pairs.groupBy("viewer_profile_id").agg(F.min_by("id", "__at").alias("owner_profile_id"))


def viewers_of(shares: DataFrame) -> DataFrame:
    return shares.select("viewer_profile_id").distinct()


def owners_of(shares: DataFrame, viewer: str) -> DataFrame:
    return shares.filter(F.col("viewer_profile_id") == viewer).select("owner_profile_id").distinct()


def visible_facts(facts: DataFrame, shares: DataFrame, viewer: str) -> DataFrame:
    """Facts of all owners that share with the viewer."""
    owners = shares.filter(F.col("viewer_profile_id") == viewer).select(F.col("owner_profile_id").alias("profile_id"))
    return facts.join(owners, "profile_id", "left_semi")
