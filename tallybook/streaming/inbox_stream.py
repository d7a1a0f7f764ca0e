"""Incremental inbox: every file content of a profile enters bronze exactly once.

A Structured Streaming file source finds new files; each micro-batch hashes them, drops known contents and
writes bronze, then the registry. Both tables are partitioned by the batch number and written by dynamic
partition overwrite, so a batch that is run again after a failure replaces its own output. The registry is the
history of files and is only written; contents are looked up in a compacted index (``sources/contents.py``), whose entry
commits the batch:

* lost before the commit: the rerun writes the same partitions again, since the contents are not known yet;
* lost after it: contents of the same batch do not count as known, so the rerun computes and writes the same files
  once more.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallybook.sources.contents import commit_batch, known_contents
from tallybook.sources.inbox import _literal, describe_files, file_contents, new_contents, read_statements
from tallybook.sources.lake import Lake

BATCHED = ("profile_id", "ingest_batch")
_LOG = logging.getLogger(__name__)


def ingest_files(
    spark: SparkSession,
    files: list[Row],
    lake: Lake,
    batch: str,
    fmt: str = "parquet",
) -> int:
    """Bring files (path, uri, length) into bronze and the registry; returns the number of new contents."""
    # The file source may hand a file of a batch twice; read twice, its lines would count twice.
    files = list({f.uri: f for f in files}.values())
    if not files:
        return 0
    hashed = file_contents(spark, files)
    # One row for each file of the batch. Kept, so that no file is hashed twice.
    contents = spark.createDataFrame(hashed.collect(), hashed.schema)
    known = known_contents(spark, lake, contents, batch)
    found = new_contents(contents, known).collect()
    fresh = [f for f in found if f.header]
    for f in found:
        if not f.header:
            _LOG.warning("no header, not loaded: %s", f.path)
    if not fresh:
        return 0
    rows = read_statements(spark, fresh).withColumn("ingest_batch", F.lit(batch))
    _overwrite(rows.hint("rebalance", *BATCHED), lake.bronze, fmt)
    entries = spark.createDataFrame(
        [(f.file, f.sha256, f.length, f.profile_id, batch) for f in fresh],
        "file string, sha256 string, bytes long, profile_id string, ingest_batch string",
    ).withColumn("ingested_at", F.current_timestamp())
    _overwrite(entries.coalesce(1), lake.registry, fmt)
    commit_batch(spark, lake, entries, batch)
    return len(fresh)


def _overwrite(df: DataFrame, path: str, fmt: str) -> None:
    writer = df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*BATCHED).save(path)


def ingest_inbox(
    spark: SparkSession,
    inbox: str,
    lake: Lake,
    checkpoint: str,
    archive: str | None = None,
    max_files: int = 1000,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Start one run over everything new in ``inbox/<profile>/*.csv``; it ends by itself.

    The folder below the inbox names the owner. Files elsewhere, deeper or right in the inbox, have none and stay unread.

    ``archive`` moves files away once their batch is committed, under their own path. A run moves the files
    of its last batch when the next run starts; the registry keeps the time of ingestion.
    """
    source = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("maxFilesPerTrigger", max_files)
    )
    if archive is not None:
        source = source.option("cleanSource", "archive").option("sourceArchiveDir", archive)

    def load(batch: DataFrame, number: int) -> None:
        files = batch.collect()  # names and sizes, at most max_files
        # Numbers start again with a new checkpoint; the query id, kept in the checkpoint, tells them apart.
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        ingest_files(batch.sparkSession, files, lake, f"{run}-{number:09d}", fmt)

    # Described before the batch function sees them: the content column is pruned and no file is read.
    return (
        describe_files(source.load(f"{_literal(inbox)}/*/*.csv"))
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
