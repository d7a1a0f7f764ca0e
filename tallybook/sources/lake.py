"""Lake tables: where they lie, how they are read and written."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallybook import schemas


@dataclass(frozen=True)
class Lake:
    """Folders of the lake tables under one root on shared storage."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def categorized(self) -> str:
        return f"{self.root}/silver_categorized"

    @property
    def fact(self) -> str:
        return f"{self.root}/gold/fact_transactions"

    @property
    def monthly(self) -> str:
        return f"{self.root}/gold/agg_category_monthly"

    @property
    def registry(self) -> str:
        return f"{self.root}/meta/file_registry"

    @property
    def contents(self) -> str:
        return f"{self.root}/meta/file_contents"

    @property
    def folders(self) -> str:
        return f"{self.root}/meta/fact_folders"


# Partition columns of the lake tables.
BY_PROFILE = ("profile_id",)
BY_PROFILE_MONTH = ("profile_id", "year", "month")

# Files that a task keeps open at once in writes without a sort.
OPEN_FILES = 64


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Read with a declared schema: no inference job, and a profile named 007 stays text."""
    return spark.read.format(fmt).schema(schema).load(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    try:
        return read_table(spark, path, schema, fmt)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_table(
    df: DataFrame,
    path: str,
    by: tuple[str, ...] = BY_PROFILE_MONTH,
    fmt: str = "parquet",
    replace: str = "table",
    regroup: bool = True,
) -> None:
    """Write a partitioned table. ``replace``: the whole table, or only the ``partitions`` present in ``df``.

    ``regroup`` is for rows in any order. The rebalance hint brings rows of a partition folder together, so tasks
    do not each open every folder; adaptive execution then splits a folder that holds a large share of the rows over
    several tasks and merges small ones. Rows that come folder by folder already, from a table with the same folders or
    from ``dealt``, need no exchange: a task writes to the few folders it has. Nor are they sorted by folder, which
    would spill where a task has much: a task keeps a file open for each of its folders, and sorts only what
    belongs to folders beyond ``OPEN_FILES``.
    """
    rows = df.hint("rebalance", *by) if regroup else df
    writer = rows.write.format(fmt).mode("overwrite").partitionBy(*by)
    if fmt == "parquet":
        writer = writer.option("compression", "zstd")
    writer = writer.option("partitionOverwriteMode", "dynamic" if replace == "partitions" else "static")
    with nullcontext() if regroup else unsorted_writes(df.sparkSession):
        writer.save(path)


@contextmanager
def unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Writes within go to up to ``OPEN_FILES`` partition folders of a task at a time, without a sort by folder before."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, OPEN_FILES)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def spread(df: DataFrame) -> DataFrame:
    """Deal out the rows of an input with few splits over all cores, before work that costs time for each row.

    Splits are counted first: a large input has more of them than there are cores and passes unchanged,
    without an exchange.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() <= cores else df


def read_bronze(spark: SparkSession, lake: Lake, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, lake.bronze, schemas.BRONZE, fmt)


def read_silver(spark: SparkSession, lake: Lake, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, lake.silver, schemas.SILVER, fmt)


def read_categorized(spark: SparkSession, lake: Lake, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, lake.categorized, schemas.CATEGORIZED, fmt)


def read_fact(spark: SparkSession, lake: Lake, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, lake.fact, schemas.FACT, fmt)


def read_monthly(spark: SparkSession, lake: Lake, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, lake.monthly, schemas.MONTHLY, fmt)
