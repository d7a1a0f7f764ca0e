"""From newly loaded batches to silver, labels, facts and monthly totals, touching only the folders they fall into.

A transaction's key holds its profile and date, so copies of it lie in one (profile, year, month) folder, and which copy survives is
decided by a total order: the survivors of a folder together with new rows are those of all rows that ever came. So:

1. the rows of the pending batches are standardized; their folders are the touched ones;
2. silver's touched folders, read by path, and the new rows are deduplicated and replace these folders;
3. the same folders are labelled, and become facts, row by row without an exchange;
4. monthly totals of the touched months are summed anew from the written facts and replace those of before. Adding
   differences instead would count twice if a run is repeated; the folders have to be read in any case;
5. the folder statistics take over the touched folders, and the batches stop being pending.

Every step replaces what it writes and depends only on what was complete before, so a run that died is simply run again.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook import schemas
from tallybook.operators.first_match import categorize
from tallybook.operators.rollups import category_monthly, fact_transactions
from tallybook.operators.standardize import dedup_transactions, standardize
from tallybook.sources.contents import State, opened, write_state
from tallybook.sources.folders import Folder, folder_statistics, note_folders, read_folders
from tallybook.sources.lake import BY_PROFILE, BY_PROFILE_MONTH, Lake, read_categorized, read_fact, read_silver, write_table


def touched_folders(rows: DataFrame) -> list[Folder]:
    """The (profile, year, month) of some rows; as many as a batch of statements has months."""
    return [tuple(r) for r in rows.select(*BY_PROFILE_MONTH).distinct().collect()]


def refresh_silver(spark: SparkSession, lake: Lake, batches: Sequence[str]) -> list[Folder]:
    """Bring batches of bronze into silver; returns the folders that were replaced."""
    # Each batch is a folder below its profile, so the filter prunes.
    bronze = spark.read.schema(schemas.BRONZE).parquet(lake.bronze).filter(F.col("ingest_batch").isin(list(batches)))
    new = standardize(bronze)
    folders = touched_folders(new)
    if folders:
        before = read_folders(spark, lake.silver, schemas.SILVER, folders)
        both = new.select(*schemas.SILVER.names).unionByName(before.select(*schemas.SILVER.names))
        write_table(dedup_transactions(both), lake.silver, replace="partitions")
    return folders


def refresh_gold(spark: SparkSession, lake: Lake, rules: list[dict[str, Any]], folders: list[Folder]) -> None:
    """Label the given folders of silver anew and carry them into facts, totals and folder statistics."""
    silver = read_folders(spark, lake.silver, schemas.SILVER, folders)
    write_table(categorize(silver, rules), lake.categorized, replace="partitions", regroup=False)
    labelled = read_folders(spark, lake.categorized, schemas.CATEGORIZED, folders)
    write_table(fact_transactions(labelled), lake.fact, replace="partitions", regroup=False)
    facts = read_folders(spark, lake.fact, schemas.FACT, folders)
    _replace_totals(spark, lake, category_monthly(facts), folders)
    note_folders(spark, lake, folder_statistics(facts), folders)


def _replace_totals(spark: SparkSession, lake: Lake, totals: DataFrame, folders: list[Folder]) -> None:
    """Totals of a profile lie in one folder; those of its untouched months are kept as they are."""
    profiles = sorted({(f[0],) for f in folders}, key=repr)
    before = read_folders(spark, lake.monthly, schemas.MONTHLY, profiles, BY_PROFILE)
    gone = spark.createDataFrame(folders, "p string, y int, m int")
    # The touched folders of one batch: small beside the totals.
    same = F.col("profile_id").eqNullSafe(F.col("p")) & F.col("year").eqNullSafe(F.col("y")) & F.col("month").eqNullSafe(F.col("m"))
    kept = before.join(F.broadcast(gone), same, "left_anti")
    write_table(kept.unionByName(totals), lake.monthly, by=BY_PROFILE, replace="partitions")


def rules_digest(rules: list[dict[str, Any]]) -> str:
    return hashlib.sha256(json.dumps(rules, sort_keys=True, default=str).encode()).hexdigest()


def refresh(spark: SparkSession, lake: Lake, rules: list[dict[str, Any]]) -> list[Folder]:
    """Everything that is loaded but not yet in the lake's tables. Changed rules label the whole lake anew; returns the folders
    that were replaced."""
    state: State = opened(spark, lake)
    digest = rules_digest(rules)
    folders = refresh_silver(spark, lake, state.pending) if state.pending else []
    if state.rules not in (None, digest):
        rebuild_gold(spark, lake, rules)
    elif folders:
        refresh_gold(spark, lake, rules, folders)
    write_state(spark, lake, replace(state, pending=[], rules=digest))
    return folders


def rebuild_gold(spark: SparkSession, lake: Lake, rules: list[dict[str, Any]], fmt: str = "parquet") -> None:
    """Labels, facts, totals and folder statistics of the whole of silver."""
    write_table(categorize(read_silver(spark, lake, fmt), rules), lake.categorized, fmt=fmt, regroup=False)
    write_gold(spark, lake, fmt)


def write_gold(spark: SparkSession, lake: Lake, fmt: str = "parquet") -> None:
    """Fact table (no exchange), then totals and folder statistics from the written facts, which are read by a few columns."""
    write_table(fact_transactions(read_categorized(spark, lake, fmt)), lake.fact, fmt=fmt, regroup=False)
    facts = read_fact(spark, lake, fmt)
    # One folder for each profile: a profile has some thousand totals, a folder for each month a handful.
    write_table(category_monthly(facts), lake.monthly, by=BY_PROFILE, fmt=fmt)
    note_folders(spark, lake, folder_statistics(facts))
