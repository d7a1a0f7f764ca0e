"""Steps between jobs: tables in the shared folder, and connected components over them."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.plans.scratch import remove, shared_folder

#: Deletes the shuffle files of a job when it ends; else they stay until the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


@contextmanager
def _passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs planned and run in here delete their shuffle files when they end."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the folder that all executors share and read again. Cuts the lineage."""
    path = shared_folder(df.sparkSession, name)
    with _passing_shuffles(df.sparkSession):
        df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(*tables: DataFrame | None) -> None:
    """Delete the files of tables that ``stored`` has made and that no plan reads any more."""
    for table in tables:
        if table is not None:
            remove(table.sparkSession, table.stored_at)


def pack(array: np.ndarray) -> bytes:
    return zlib.compress(array.tobytes(), 1)


def merged(tables: DataFrame, dtype: type, merge: Callable, tasks: int = 4, packed: bool = False, last: Callable | None = None) -> np.ndarray | None:
    """One array of a fixed size out of many of that size, one in each row of the single binary column.

    Merged row by row in a few tasks, and the few results in one; the driver sees no array but that. ``packed``: the rows
    are made by ``pack``. ``last`` makes bytes of the merged array where it lies, and the driver sees these instead.
    """

    def folded(batches: Iterator[pa.RecordBatch], end: Callable | None = None) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for row in batch.column(0):
                value = np.frombuffer(zlib.decompress(row.as_buffer()) if packed else row.as_buffer(), dtype=dtype)
                total = value.copy() if total is None else merge(total, value, out=total)
        if total is not None:
            total = end(total) if end else pack(total) if packed else total.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.binary())], ["counters"])

    few = tables.repartition(tasks).mapInArrow(folded, "counters binary").repartition(1)
    with _passing_shuffles(tables.sparkSession):
        rows = few.mapInArrow(lambda it: folded(it, last or np.ndarray.tobytes), "counters binary").collect()
    return np.frombuffer(bytes(rows[0][0]), dtype=np.uint8 if last else dtype).copy() if rows else None


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Alternates large stars and small stars (Kiveris et al., Connected Components in MapReduce and Beyond), so that a
    hub's neighbours are only ever aggregated by a minimum, never gathered. Each round is a table in the shared folder.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), name)
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        now, old = stored(_small_star(_large_star(now)), name), now
        discard(old)
    pairs = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return pairs.union(pairs.select(F.col("component").alias("node"), "component").distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()
