"""First-match categorization with an audit trail, in two projections whatever the number of rules.

Step one evaluates every pattern once into an array of flags. Step two reads category, subcategory, audit
trail and operation stamp from the flags, so no regular expression runs twice for a row.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STRINGS = "array<string>"
_FLAGS = "__rule_flags"


def _string_array(values: list[str | None]) -> Column:
    return F.array(*[F.lit(v).cast("string") for v in values])


def stamp_of(rule: dict[str, Any]) -> str:
    sub = rule.get("subcategory")
    return f"set_category:{rule['id']}:{rule.get('category')}" + (f"/{sub}" if sub else "")


#: The columns that rules set, with their types.
LABELS = {"category": "string", "subcategory": "string", "applied_rules": _STRINGS, "operation": "string"}


def with_ids(rules: list[dict[str, Any]]) -> list[dict[str, Any]]:
    return [{**r, "id": r.get("id") or f"rule_{i}"} for i, r in enumerate(rules)]


def incoming_labels(df: DataFrame, keep_existing: bool) -> list[Column]:
    """The labels a table comes with, or none."""
    kept = set(df.columns) if keep_existing else set()
    return [(F.col(name) if name in kept else F.lit(None).cast(kind)).alias(name) for name, kind in LABELS.items()]


def categorize(df: DataFrame, rules: list[dict[str, Any]], keep_existing: bool = True) -> DataFrame:
    """Set category, subcategory, applied_rules and operation by an ordered list of regex rules.

    Each rule has ``id``, ``value`` (the pattern), optional ``category``, ``subcategory`` and ``column``
    (default ``name``). Where no category is set yet, the first matching rule with a category decides, and
    the first matching rule of any kind stamps the operation; all matching rules are listed in
    ``applied_rules``; a subcategory that is still open is filled by the first matching rule of the same
    category that has one. With ``keep_existing`` false, earlier labels are dropped first, so that changed
    rules label everything anew.
    """
    rules = with_ids(rules)
    others = [c for c in df.columns if c not in LABELS]
    labels = incoming_labels(df, keep_existing)
    if not rules:
        return df.select(*others, *labels)

    flags = F.array(*[
        F.coalesce(F.col(r.get("column") or "name").cast("string").rlike(r["value"]), F.lit(False)) for r in rules
    ])
    flagged = df.select(*others, *labels, flags.alias(_FLAGS))

    def hit(i: int) -> Column:
        return F.get(F.col(_FLAGS), F.lit(i))

    first = F.array_position(F.col(_FLAGS), F.lit(True)).cast("int") - F.lit(1)  # -1: no rule matches
    is_open = F.col("category").isNull() & (first >= 0)

    def of(position: Column, values: list[str | None]) -> Column:
        return F.when(is_open, F.get(_string_array(values), position))

    with_category = [i for i, r in enumerate(rules) if r.get("category") is not None]
    decisive = first
    if len(with_category) < len(rules):
        # -1 again if no rule with a category matches
        place = F.array_position(F.array(*[hit(i) for i in with_category]), F.lit(True)).cast("int") - F.lit(1)
        decisive = F.coalesce(F.get(F.array(*[F.lit(i) for i in with_category]).cast("array<int>"), place), F.lit(-1))

    category = F.coalesce(F.col("category"), of(decisive, [r.get("category") for r in rules]))
    stamp = F.coalesce(F.col("operation"), of(first, [stamp_of(r) for r in rules]))

    # The subcategory of the deciding rule; before it, the last matching rule without a category may set one.
    subcategory = [of(decisive, [r.get("subcategory") for r in rules])]
    early = F
    for i in reversed(range(len(rules))):
        if rules[i].get("category") is None and rules[i].get("subcategory") is not None:
            in_time = (decisive < 0) | (decisive > i)
            early = early.when(is_open & hit(i) & in_time, F.lit(rules[i]["subcategory"]))
    fill = F
    for i, rule in enumerate(rules):
        if rule.get("category") is not None and rule.get("subcategory") is not None:
            fill = fill.when(hit(i) & (category == F.lit(rule["category"])), F.lit(rule["subcategory"]))
    subcategory += [c for c in (early, F.col("subcategory"), fill) if c is not F]

    # array_except drops the NULLs of rules that did not match; array_union keeps rule order and drops repeats.
    hits = F.array_except(
        F.array(*[F.when(hit(i), F.lit(r["id"])) for i, r in enumerate(rules)]), _string_array([None])
    )
    none_yet = F.coalesce(F.col("applied_rules"), F.array().cast(_STRINGS))
    trail = F.when(first >= 0, F.array_union(none_yet, hits)).otherwise(F.col("applied_rules"))

    return flagged.select(
        *others,
        category.alias("category"),
        F.coalesce(*subcategory).alias("subcategory"),
        trail.alias("applied_rules"),
        stamp.alias("operation"),
    )
