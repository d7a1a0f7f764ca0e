"""Small tables that are replaced as a whole and must never be seen half written.

A table is kept in two folders in turn. A new version goes into the folder of the older one, as one file, so that it
appears at once; readers take the newest version there is. A writer that dies leaves the version before as it was. Nothing
is ever listed but two folders. For tables whose size is that of the lake's folder list, not of its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.sources.lake import read_or_empty

_VERSION = "table_version"
_SLOT = "slot"


def _slots(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    extra = [T.StructField(_VERSION, T.LongType()), T.StructField(_SLOT, T.IntegerType())]
    return read_or_empty(spark, path, T.StructType([*schema.fields, *extra]))


def newest(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest version, without any rows if there is none yet. Lazy: the version is found when the plan runs."""
    both = _slots(spark, path, schema)
    last = both.agg(F.max(_VERSION)).scalar()
    return both.filter((F.col(_VERSION) == last) & F.col(schema.names[0]).isNotNull()).select(*schema.names)


def replace(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Make ``df`` the newest version. Its first column is never NULL; it may be computed from the version before."""
    spark = df.sparkSession
    last = _slots(spark, path, schema).agg(F.max(_VERSION)).first()[0]
    number = 0 if last is None else last + 1
    # A row without values stands for the version itself, so that an empty one counts, too.
    marker = spark.createDataFrame([tuple(None for _ in schema)], schema)
    rows = df.select(*schema.names).unionByName(marker).coalesce(1)
    numbered = rows.withColumn(_VERSION, F.lit(number).cast("long")).withColumn(_SLOT, F.lit(number % 2))
    numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_SLOT).parquet(path)
