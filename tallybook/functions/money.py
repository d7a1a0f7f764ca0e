"""Amounts: reading them from text, signing them, turning them into spend."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybook.schemas import MONEY


def to_money(text: Column) -> Column:
    """Amount, or NULL where the text is no plain number (``1,234.50`` is none). Exact unless ``not_read`` says otherwise."""
    return text.try_cast(MONEY)


def not_read(role: str, text: Column) -> Column:
    """NULL where an amount was read exactly, or where there is none; else role, text and reason: ``no number``, ``too large``
    or ``rounded``."""
    written = F.trim(text.cast("string"))
    money, number = to_money(text), written.try_cast("double")
    rounded = F.abs(number) < 1e6  # beyond that a double shows nothing; the text itself is compared
    plain = F.regexp_extract(written, r"^[-+]?\d*\.?(\d*?)0*$", 1)
    reason = (
        F.when(written.isNull() | (written == ""), None)
        .when(money.isNull() & number.isNull(), "no number")
        .when(money.isNull(), "too large")
        .when((F.length(plain) > MONEY.scale) | (written.rlike("[eE]") & rounded & (money.cast("double") != number)), "rounded")
    )
    return F.when(reason.isNotNull(), F.struct(F.lit(role).alias("role"), text.cast("string").alias("text"), reason.alias("reason")))


def signed_amount(credit: Column | None, debit: Column | None) -> Column:
    """Money in minus money out. Banks disagree on the sign of a debit column, so both sides count as sizes."""
    zero = F.lit(0).cast(MONEY)

    def size(side: Column | None) -> Column:
        return zero if side is None else F.abs(F.coalesce(to_money(side), zero))

    return (size(credit) - size(debit)).try_cast(MONEY)


def outflow(amount: Column) -> Column:
    """Spend of one transaction as a number >= 0; money in and missing amounts spend nothing."""
    zero = F.lit(0).cast(MONEY)
    return -F.least(zero, F.coalesce(amount, zero))


def money_text(amount: Column) -> Column:
    """All digits of an amount, without zeros at the end but one behind the point, and never with an exponent."""
    return F.regexp_replace(amount.cast("string"), r"(\.\d+?)0+$", "$1")
