"""Statement tables with any known header, brought to the six canonical columns."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.money import not_read, signed_amount, to_money
from tallybook.schemas import MONEY, ROLE_ALIASES, UNREAD


def role_columns(header: list[str]) -> dict[str, str]:
    """Header name that fills each role. A name that occurs twice in a header is ambiguous and fills none."""
    counts = Counter(name.lower() for name in header)
    by_lower = {name.lower(): name for name in header if counts[name.lower()] == 1}
    found = {}
    for role, aliases in ROLE_ALIASES.items():
        hit = next((a for a in aliases if a in by_lower), None)
        if hit is not None:
            found[role] = by_lower[hit]
    return found


def canonicalize(raw: DataFrame, keep: tuple[str, ...] = (), with_unread: bool = False) -> DataFrame:
    """Select post_date, description, amount, currency, account_id and balance (then ``keep``) from ``raw``.

    ``with_unread`` adds what stood in the amount columns and was not read, NULL for nearly all rows.
    """
    roles = role_columns(raw.columns)

    def column(role: str) -> Column | None:
        # Back-quoted, as names such as "Withdrawal Amt." hold a dot.
        return F.col("`" + roles[role].replace("`", "``") + "`") if role in roles else None

    def text(role: str) -> Column:
        found = column(role)
        return F.lit(None).cast("string") if found is None else found.cast("string")

    amount = column("amount")
    balance = column("balance")
    values = {
        "post_date": text("post_date"),
        "description": text("description"),
        "amount": signed_amount(column("credit"), column("debit")) if amount is None else to_money(amount),
        "currency": text("currency"),
        "account_id": text("account_id"),
        "balance": F.lit(None).cast(MONEY) if balance is None else to_money(balance),
    }
    if with_unread:
        read = ("credit", "debit", "balance") if amount is None else ("amount", "balance")
        faults = [not_read(role, column(role)) for role in read if role in roles]
        found = F.array_compact(F.array(*faults)) if faults else F.array()
        values["unread"] = F.when(F.size(found) > 0, found).cast(UNREAD)
    return raw.select(*[value.alias(name) for name, value in values.items()], *[F.col(k) for k in keep])


def canonical_rows(texts: DataFrame, one_amount: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """As ``canonicalize`` with ``unread``, for rows of different layouts: a text column for each role, NULL where a row's
    layout lacks it. ``one_amount`` says whether that has an amount column; else debit and credit count."""
    amount = F.when(one_amount, to_money(F.col("amount"))).otherwise(signed_amount(F.col("credit"), F.col("debit")))
    one = {"amount": one_amount, "credit": ~one_amount, "debit": ~one_amount, "balance": F.lit(True)}
    found = F.array_compact(F.array(*[F.when(counts, not_read(role, F.col(role))) for role, counts in one.items()]))
    return texts.select(
        "post_date", "description", amount.alias("amount"), "currency", "account_id", to_money(F.col("balance")).alias("balance"),
        F.when(F.size(found) > 0, found).cast(UNREAD).alias("unread"), *keep,
    )


def unread_values(bronze: DataFrame) -> DataFrame:
    """One row for each value of a statement that was not read as it stands; few, and cut out of bronze by a pushed filter."""
    some = bronze.filter(F.col("unread").isNotNull())
    return some.select("profile_id", "ingest_batch", "source_file", "source_sha256", "post_date", "description", F.explode("unread").alias("u")).select("*", "u.*").drop("u")
