"""Description text, transaction keys and display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNCATEGORIZED = "Uncategorized"
MISSING = "—"

# Characters removed at both ends of the description before it enters the key: ASCII and Unicode white space.
_EDGE_SPACE = "".join(map(chr, (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
    0x205F, 0x3000,
)))


def clean_desc(description: Column) -> Column:
    """Lower case, with every run of white space as one space. Ends are not trimmed."""
    return F.lower(F.regexp_replace(description, r"\s+", " "))


def txn_id(profile: Column, account: Column, post_date: Column, amount: Column, desc: Column) -> Column:
    """Stable 16-digit key: the head of a SHA-256 over the five identifying values."""
    empty = F.lit("")
    cents = F.coalesce(amount, F.lit(0)).cast(T.DecimalType(18, 2)).cast("string")
    payload = F.concat_ws(
        "|",
        F.coalesce(profile, empty),
        F.coalesce(account, empty),
        F.coalesce(post_date.cast("string"), empty),
        cents,
        F.lower(F.trim(F.coalesce(desc, empty), F.lit(_EDGE_SPACE))),
    )
    return F.substring(F.sha2(payload, 256), 1, 16)


def txn_piece(account: Column, post_date: Column, amount: Column) -> Column:
    """A number that is equal for rows of a profile with equal ``txn_id``, at a small part of its price.

    It hashes the text of the key behind the profile, up to the third bar. That is before the description begins, also if an
    account holds bars.
    """
    empty = F.lit("")
    cents = F.coalesce(amount, F.lit(0)).cast(T.DecimalType(18, 2)).cast("string")
    head = F.concat_ws("|", F.coalesce(account, empty), F.coalesce(post_date.cast("string"), empty), cents)
    return F.xxhash64(F.substring_index(head, "|", 3))


def category_label(category: Column) -> Column:
    """Category as reports show it."""
    return F.coalesce(category, F.lit(UNCATEGORIZED))


def first_filled(*choices: Column) -> Column:
    """First choice that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in choices])


def or_dash(value: Column) -> Column:
    """Empty and missing values as a dash."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(MISSING))
