"""Bronze to silver: types, dates, clean text, transaction key, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions.dates import CENTURY_PIVOT, with_parsed_date
from tallybook.functions.money import to_money
from tallybook.functions.text import clean_desc, txn_id, txn_piece
from tallybook.schemas import SILVER

SOURCE = ("source_file", "source_sha256")

# Which copy of a transaction survives. Rows equal in all of these are equal in every silver column.
SURVIVOR_ORDER = ("balance", "amount", "description", "currency", "source_file", "source_sha256")


# Column that ``dealt`` adds: rows of a profile with equal keys have equal pieces.
PIECE = "__piece"


def _dated(bronze: DataFrame, century_pivot: int) -> DataFrame:
    """A post_date that is a DATE already is taken as it is."""
    if bronze.schema["post_date"].dataType == T.DateType():
        return bronze
    return with_parsed_date(bronze, "post_date", "post_date", century_pivot)


def dealt(bronze: DataFrame, by_folder: bool = True, century_pivot: int = CENTURY_PIVOT) -> DataFrame:
    """Bronze rows so dealt out that all copies of a transaction are in one task: the only exchange that silver needs.

    ``by_folder`` deals ranges of profile and date, so a task also has whole month folders, or a part of one if that holds a large
    share of the rows: what comes of it is written with ``regroup=False``. Else rows are dealt by hash.

    Only what statements hold is moved. Clean text and key are made of it afterwards by ``standardize``, which passes the added
    column on to ``dedup_transactions``; that finds the copies of a key where they are and drops the column.
    """
    kept = ("profile_id", "account_id", "post_date", "amount", "currency", "description", "balance", *SOURCE)
    rows = _dated(bronze, century_pivot).select(*[
        F.col(c).cast("string").alias(c) if c in ("profile_id", "account_id", "description") else to_money(F.col(c)).alias(c) if c in ("amount", "balance") else F.col(c)
        for c in kept if c in bronze.columns
    ])
    piece = txn_piece(*[F.col(c) for c in ("account_id", "post_date", "amount")])
    rows = rows.withColumn(PIECE, piece)
    deal = rows.repartitionByRange if by_folder else rows.repartition
    return deal("profile_id", "post_date", PIECE)


def standardize(bronze: DataFrame, century_pivot: int = CENTURY_PIVOT) -> DataFrame:
    """Typed silver rows with key and defaults, duplicates still in. Projections only, no shuffle.

    A post_date that is a DATE already is taken as it is, so filters on it still reach the scan.
    """
    has_source = {"source_file", "source_sha256"} <= set(bronze.columns)
    bronze = _dated(bronze, century_pivot)
    piece = [c for c in (PIECE,) if c in bronze.columns]
    typed = bronze.select(
        F.col("profile_id").cast("string").alias("profile_id"),
        F.col("account_id").cast("string").alias("account_id"),
        "post_date",
        to_money(F.col("amount")).alias("amount"),
        F.col("currency").cast("string").alias("currency"),
        F.col("description").cast("string").alias("description"),
        F.col("description").cast("string").alias("name"),
        clean_desc(F.col("description")).alias("clean_desc"),
        to_money(F.col("balance")).alias("balance"),
        *[
            (F.col(c) if has_source else F.lit(None).cast("string")).alias(c)
            for c in ("source_file", "source_sha256")
        ],
        *piece,
    )
    return typed.select(
        txn_id(*[F.col(c) for c in ("profile_id", "account_id", "post_date", "amount", "clean_desc")]).alias(
            "txn_id"
        ),
        "account_id", "post_date", "amount", "currency", "description", "name", "clean_desc", "balance",
        F.lit(None).cast("string").alias("merchant"),
        F.lit(None).cast("string").alias("category"),
        F.lit(False).alias("is_transfer"),
        "source_file", "source_sha256", "profile_id",
        F.year("post_date").alias("year"),
        F.month("post_date").alias("month"),
        *piece,
    )


KEY = ("txn_id", "profile_id", "post_date")


def _key(silver: DataFrame) -> tuple[str, ...]:
    """The columns that copies share. In the order of dealt rows, if they are, so that rows of a folder stay together."""
    return ("profile_id", "post_date", PIECE, "txn_id") if PIECE in silver.columns else KEY


def _survivors_first(silver: DataFrame) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in SURVIVOR_ORDER if c in silver.columns]


def dedup_transactions(silver: DataFrame, repeats: bool = False) -> DataFrame:
    """One row for each transaction key; with ``repeats``, one for each real occurrence (see ``reconcile_repeats``).

    Profile and date are part of the key's text, so grouping by them too changes nothing, except that a
    chance collision of two 64-bit keys, which happens at trillions of rows, loses no transaction.

    Catalyst turns ``row_number() = 1`` into a group limit before and after the exchange, so a key with very
    many copies leaves each map task as a single row. The order is total: the survivor never depends on
    how rows were spread over tasks.

    That limit sorts the rows of each map task, which spills where tasks read much. Rows that were ``dealt`` are not moved
    again; their copies are cut where they are, so all copies of one key come to one task.
    """
    if repeats:
        return reconcile_repeats(silver)
    copies = Window.partitionBy(*_key(silver)).orderBy(*_survivors_first(silver))
    return silver.withColumn("__copy", F.row_number().over(copies)).filter("__copy = 1").drop("__copy", PIECE)


def reconcile_repeats(silver: DataFrame) -> DataFrame:
    """Silver with real repeats kept: each key as often as the one file that holds it most often; ``occurrence`` counts from 1.

    Two equal purchases on one day stand twice in the same statement and stay two. The same statement sent again, or another
    one that overlaps it, adds nothing. So occurrences are numbered within a file, and of the same occurrence of a key in
    several files one row survives, as in ``dedup_transactions``.

    All rows of a key come together in one exchange, unless they were ``dealt`` already; both numberings follow it, each a sort
    within the task. Only the columns that order the rows and those the caller selects are moved and sorted.
    """
    key = _key(silver)
    rows = silver if PIECE in silver.columns else silver.repartition(*KEY)
    # Columns that ``standardize`` makes are the same for rows equal in key and order; of others the order must know.
    more = [F.col(c) for c in silver.columns if c not in (*SILVER.names, PIECE)]
    in_file = Window.partitionBy(*key, *[c for c in SOURCE if c in silver.columns]).orderBy(*_survivors_first(silver), *more)
    numbered = rows.withColumn("occurrence", F.row_number().over(in_file))
    copies = Window.partitionBy(*key, "occurrence").orderBy(*_survivors_first(silver), *more)
    return numbered.withColumn("__copy", F.row_number().over(copies)).filter("__copy = 1").drop("__copy", PIECE)
