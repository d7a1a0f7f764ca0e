"""Single folders of a partitioned lake table, read by path, and statistics of the fact table's folders.

The statistics (``FOLDERS``: rows, first and last day of each folder) are kept with every write of facts. They hold as many
rows as there are folders, and answer for bounds and calendars without any data file being opened.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.schemas import FOLDERS
from tallybook.sources import versions
from tallybook.sources.lake import BY_PROFILE_MONTH, Lake

Folder = tuple[object, ...]

# How values become folder names, as all writers of Hive-style tables do it.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = frozenset([*map(chr, range(1, 0x20)), *"\"#%'*/:=?\\{[]^\x7f"])


def folder_name(column: str, value: object) -> str:
    if value is None or value == "":
        return f"{column}={_NO_VALUE}"
    return f"{column}=" + "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in str(value))


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of the paths that are there."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    there = []
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        if place.getFileSystem(conf).exists(place):
            there.append(path)
    return there


def read_folders(
    spark: SparkSession, path: str, schema: T.StructType, folders: Sequence[Folder], by: Sequence[str] = BY_PROFILE_MONTH
) -> DataFrame:
    """The rows of some folders of a table; the rest of the table is not even listed. Folders that are not there have no rows."""
    names = ["/".join([path, *(folder_name(c, v) for c, v in zip(by, f))]) for f in folders]
    there = existing(spark, names)
    if not there:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*there)


def folder_statistics(facts: DataFrame) -> DataFrame:
    """profile_id, year, month, rows, min_date, max_date for each folder; of the data only one column is read."""
    return facts.groupBy(*BY_PROFILE_MONTH).agg(
        F.count(F.lit(1)).alias("rows"), F.min("post_date").alias("min_date"), F.max("post_date").alias("max_date")
    )


def read_folder_statistics(spark: SparkSession, lake: Lake) -> DataFrame:
    return versions.newest(spark, lake.folders, FOLDERS)


def note_folders(spark: SparkSession, lake: Lake, statistics: DataFrame, folders: Sequence[Folder] | None = None) -> None:
    """Replace the statistics of these folders, or of all. Without a profile a folder has the name of no profile, ``''``."""
    rows = statistics.withColumn("profile_id", F.coalesce("profile_id", F.lit("")))
    if folders is not None:
        touched = spark.createDataFrame(list(folders), "p string, y int, m int")
        same = F.col("profile_id").eqNullSafe(F.coalesce("p", F.lit(""))) & F.col("year").eqNullSafe(F.col("y")) & F.col("month").eqNullSafe(F.col("m"))
        rows = rows.unionByName(read_folder_statistics(spark, lake).join(F.broadcast(touched), same, "left_anti"))
    versions.replace(rows, lake.folders, FOLDERS)
