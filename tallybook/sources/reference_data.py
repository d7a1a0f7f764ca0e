"""Small configuration tables: profiles and taxonomy."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.schemas import PROFILE
from tallybook.sources.rules import read_yaml


def profiles_table(spark: SparkSession, profiles: list[dict[str, Any]]) -> DataFrame:
    """Profiles as rows; ``position`` keeps their order."""
    schema = T.StructType([T.StructField("position", T.IntegerType()), *PROFILE.fields])
    return spark.createDataFrame(
        [{"position": i, **{k: p.get(k) for k in PROFILE.names}} for i, p in enumerate(profiles)], schema
    )


def load_profiles_yaml(spark: SparkSession, path: str) -> DataFrame:
    """Profiles from a YAML file with a top-level ``profiles`` list, in any store."""
    return profiles_table(spark, (read_yaml(path, spark) or {}).get("profiles", []))


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """category, subcategory, description. A description may hold commas without being quoted."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    cells = F.split("value", ",", 3)
    return lines.select(
        *[F.get(cells, F.lit(i)).alias(n) for i, n in enumerate(("category", "subcategory"))],
        F.regexp_replace(F.get(cells, F.lit(2)), r'^"(.*)"$', "$1").alias("description"),
    ).filter((F.col("category") != "category") | (F.col("subcategory") != "subcategory"))
