"""Table layouts shared by the jobs."""

from __future__ import annotations

from pyspark.sql import types as T

# Money is exact: sums do not depend on task order. 22 digits before the point and 8 behind it hold amounts in any
# currency, and prices of small units; a sum of any number of them still fits into 38 digits.
MONEY = T.DecimalType(30, 8)

# Header names accepted for each role, compared in lower case. The order of a list is the
# order of preference, whatever the order of the columns in the file.
ROLE_ALIASES: dict[str, list[str]] = {
    "post_date": [
        "post_date", "transaction date", "transaction_date", "date", "txn_date", "value date", "posting date",
    ],
    "description": ["description", "narration", "details", "transaction details", "remarks"],
    "amount": ["amount", "amt", "transaction amount", "value"],
    "debit": ["debit", "withdrawal amt.", "dr amount", "withdrawal amount", "dr"],
    "credit": ["credit", "deposit amt.", "cr amount", "deposit amount", "cr"],
    "balance": ["balance", "running balance", "closing balance"],
    "currency": ["currency", "curr"],
    "account_id": ["account_id", "account number", "account no", "acct no", "account"],
}


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _I, _D, _B = T.StringType(), T.IntegerType(), T.DateType(), T.BooleanType()
_IDS = T.ArrayType(_S)

# Values of a statement that are no amount, or not exactly the amount that was read: the role of the column, the text, and why.
UNREAD = T.ArrayType(_struct(role=_S, text=_S, reason=_S))

BRONZE = _struct(
    post_date=_S, description=_S, amount=MONEY, currency=_S, account_id=_S, balance=MONEY, unread=UNREAD,
    source_file=_S, source_sha256=_S, profile_id=_S, ingest_batch=_S,
)

SILVER = _struct(
    txn_id=_S, account_id=_S, post_date=_D, amount=MONEY, currency=_S, description=_S, name=_S, clean_desc=_S,
    balance=MONEY, merchant=_S, category=_S, is_transfer=_B, source_file=_S, source_sha256=_S,
    profile_id=_S, year=_I, month=_I,
)

CATEGORIZED = T.StructType(
    SILVER.fields[:-3]
    + _struct(subcategory=_S, applied_rules=_IDS, operation=_S).fields
    + SILVER.fields[-3:]
)

FACT = _struct(
    profile_id=_S, txn_id=_S, account_id=_S, post_date=_D, year=_I, month=_I, amount=MONEY, currency=_S,
    name=_S, clean_desc=_S, merchant=_S, category=_S, subcategory=_S, applied_rules=_IDS, operation=_S,
    is_transfer=_B, balance=MONEY,
)

MONTHLY = _struct(
    profile_id=_S, year=_I, month=_I, category=_S, subcategory=_S, total_amount=T.DecimalType(38, 8),
)

# One row for each folder of the fact table; in this order, as the first column is never NULL.
FOLDERS = _struct(profile_id=_S, year=_I, month=_I, rows=T.LongType(), min_date=_D, max_date=_D)

REGISTRY = _struct(
    file=_S, sha256=_S, bytes=T.LongType(), ingested_at=T.TimestampType(), profile_id=_S, ingest_batch=_S,
)

PROFILE = _struct(
    id=_S,
    display_name=_S,
    share_with=_IDS,
    accounts=T.ArrayType(_struct(account_id=_S, bank=_S, currency=_S)),
)

SHARES = _struct(owner_profile_id=_S, viewer_profile_id=_S)

TAXONOMY = _struct(category=_S, subcategory=_S, description=_S)

GENERIC_RULE = _struct(
    id=_S,
    priority=_I,
    logic=_S,
    match=T.ArrayType(_struct(column=_S, op=_S, value=_S, values=_IDS, case_insensitive=_B)),
    actions=T.ArrayType(_struct(set=_struct(target=_S, value=_S))),
    stop_after_match=_B,
    profiles=_IDS,
)
