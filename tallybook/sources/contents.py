"""Which file contents a profile has loaded, in a form whose lookup does not slow down with the number of batches.

* ``log``: the entries of each batch since the last compaction, a folder each.
* ``base``: all older entries, hashed into buckets, so that a batch reads only the buckets of its own contents.
* ``state``: one row that names the generation of the base, the batches in the log, and those that wait for silver.

A batch is committed by its row in the state; a log folder that is not named there does not count. Everything is read by path:
at most ``LOG_BATCHES`` folders of the log, the needed buckets, and the two folders of the state. When the log is
full, base and log are merged into the base of the next generation, in another folder, before the state names it. One
writer at a time.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.schemas import REGISTRY
from tallybook.sources import versions
from tallybook.sources.lake import Lake, read_or_empty, read_table

LOG_BATCHES = 64
BUCKETS = 256

_TEXT, _TEXTS = T.StringType(), T.ArrayType(T.StringType())
ENTRY = T.StructType([T.StructField(c, _TEXT) for c in ("profile_id", "sha256", "ingest_batch")])
_BUCKETED = T.StructType([*ENTRY.fields, T.StructField("bucket", T.IntegerType())])
_STATE = T.StructType([
    T.StructField("generation", T.LongType()),
    T.StructField("buckets", T.ArrayType(T.IntegerType())),
    T.StructField("log", _TEXTS),
    T.StructField("pending", _TEXTS),
    T.StructField("rules", _TEXT),
])


@dataclass(frozen=True)
class State:
    """``pending``: committed batches that silver does not hold yet. ``rules``: digest of the rules the lake is labelled by."""

    generation: int = 0
    buckets: list[int] = field(default_factory=list)
    log: list[str] = field(default_factory=list)
    pending: list[str] = field(default_factory=list)
    rules: str | None = None


def read_state(spark: SparkSession, lake: Lake) -> State | None:
    row = versions.newest(spark, f"{lake.contents}/state", _STATE).first()
    return State(**row.asDict()) if row else None


def write_state(spark: SparkSession, lake: Lake, state: State) -> None:
    row = (state.generation, state.buckets, state.log, state.pending, state.rules)
    versions.replace(spark.createDataFrame([row], _STATE), f"{lake.contents}/state", _STATE)


def _base(lake: Lake, generation: int) -> str:
    return f"{lake.contents}/base-{generation % 2}"


def _log(lake: Lake, generation: int, batch: str) -> str:
    return f"{lake.contents}/log-{generation % 2}/{batch}"


def _bucket(buckets: int = BUCKETS):
    return F.pmod(F.xxhash64("sha256"), F.lit(buckets)).cast("int")


def _entries(spark: SparkSession, lake: Lake, state: State, buckets: Iterable[int]) -> DataFrame:
    """profile_id, sha256, ingest_batch of the log and of some buckets of the base."""
    found = spark.createDataFrame([], ENTRY)
    logs = [_log(lake, state.generation, b) for b in state.log]
    if logs:
        found = found.unionByName(spark.read.schema(ENTRY).parquet(*logs))
    some = sorted(set(buckets) & set(state.buckets))
    if some:
        base = _base(lake, state.generation)
        found = found.unionByName(spark.read.schema(ENTRY).parquet(*[f"{base}/bucket={b}" for b in some]))
    return found


def opened(spark: SparkSession, lake: Lake) -> State:
    """The state; for a lake from before the index, the base is made of its registry, once."""
    state = read_state(spark, lake)
    if state is None:
        history = read_or_empty(spark, lake.registry, REGISTRY).select(*ENTRY.names)
        state = State() if history.isEmpty() else _rebased(spark, lake, State(), history)
    return state


def known_contents(spark: SparkSession, lake: Lake, keys: DataFrame, batch: str) -> DataFrame:
    """Those of ``keys`` (profile_id, sha256) that another batch has loaded. The keys are those of one batch of files."""
    buckets = [r[0] for r in keys.select(_bucket().alias("bucket")).distinct().collect()]
    entries = _entries(spark, lake, opened(spark, lake), buckets).filter(F.col("ingest_batch") != batch)
    # A batch of files bounds the keys, so they go to the entries; these are never shuffled.
    return entries.join(F.broadcast(keys.select("profile_id", "sha256").distinct()), ["profile_id", "sha256"], "left_semi")


def commit_batch(spark: SparkSession, lake: Lake, entries: DataFrame, batch: str, log_batches: int = LOG_BATCHES) -> None:
    """Enter the contents (profile_id, sha256) of a batch, whose rows are complete in bronze. A batch may come again."""
    state = opened(spark, lake)
    if len(state.log) >= log_batches and batch not in state.log:
        state = compacted(spark, lake, state)
    rows = entries.select("profile_id", "sha256", F.lit(batch).alias("ingest_batch"))
    rows.coalesce(1).write.mode("overwrite").parquet(_log(lake, state.generation, batch))
    again = [b for b in state.log if b != batch], [b for b in state.pending if b != batch]
    write_state(spark, lake, replace(state, log=[*again[0], batch], pending=[*again[1], batch]))


def compacted(spark: SparkSession, lake: Lake, state: State) -> State:
    """Merge the log into a base of the next generation. Two folders of logs and bases take turns; old ones are overwritten."""
    return _rebased(spark, lake, state, _entries(spark, lake, state, state.buckets))


def _rebased(spark: SparkSession, lake: Lake, state: State, entries: DataFrame) -> State:
    path = _base(lake, state.generation + 1)
    entries.distinct().withColumn("bucket", _bucket()).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
    buckets = [r[0] for r in read_table(spark, path, _BUCKETED).select("bucket").distinct().collect()]
    # What the log of two generations ago has left is of no use any more.
    spark.createDataFrame([], ENTRY).write.mode("overwrite").parquet(f"{lake.contents}/log-{(state.generation + 1) % 2}")
    after = replace(state, generation=state.generation + 1, buckets=sorted(buckets), log=[])
    write_state(spark, lake, after)
    return after
