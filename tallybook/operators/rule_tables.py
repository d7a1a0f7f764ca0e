"""Priority rules as four flat tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def normalize_rules(rules: DataFrame) -> dict[str, DataFrame]:
    """Tables rules, predicates, actions and rule_profiles from rows with the GENERIC_RULE layout."""
    predicates = rules.select("id", F.posexplode("match").alias("idx", "p"))
    actions = rules.select("id", F.posexplode("actions").alias("idx", "a"))
    return {
        "rules": rules.select(
            "id",
            F.coalesce("priority", F.lit(1000)).alias("priority"),
            F.coalesce("logic", F.lit("all")).alias("logic"),
            F.coalesce("stop_after_match", F.lit(False)).alias("stop_after_match"),
        ),
        "predicates": predicates.select(
            "id", "idx",
            F.col("p.column").alias("column_name"),
            F.col("p.op").alias("op"),
            F.col("p.value").alias("value"),
            F.to_json("p.values").alias("values_json"),
        ),
        "actions": actions.select(
            "id", "idx", F.col("a.set.target").alias("target"), F.col("a.set.value").alias("set_value")
        ),
        "rule_profiles": rules.select("id", F.explode("profiles").alias("profile")).distinct(),
    }


def write_rule_tables(rules: DataFrame, path: str) -> None:
    for name, table in normalize_rules(rules).items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")
