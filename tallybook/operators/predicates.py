"""Rule predicates as boolean columns."""

from __future__ import annotations

import operator
from collections.abc import Iterable
from decimal import Decimal, InvalidOperation
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMERIC = {"gt": operator.gt, "gte": operator.ge, "lt": operator.lt, "lte": operator.le}
OPERATORS = ("equals", "contains", "regex", "startswith", "endswith", "in", *_NUMERIC, "between")


def _fold(value: Any, ignore_case: bool) -> Any:
    return value.lower() if ignore_case and isinstance(value, str) else value


def _same(raw: Column, value: Any, ignore_case: bool) -> Column:
    """Equal to a literal of any type. A column of another type is read as the literal's; what can't be read is unequal."""
    if value is None:
        return raw.isNull()
    if isinstance(value, bool):
        return raw.try_cast("boolean").eqNullSafe(F.lit(value))
    if isinstance(value, int):
        return raw.try_cast("decimal(38,10)").eqNullSafe(F.lit(value).cast("decimal(38,10)"))
    if isinstance(value, float):
        return raw.try_cast("double").eqNullSafe(F.lit(value))
    text = raw.cast("string")
    spelled = (F.lower(text) if ignore_case else text).eqNullSafe(F.lit(_fold(str(value), ignore_case)))
    number = None if ignore_case else _number(str(value))
    if number is None:
        return spelled
    # The type of the column is known when the plan is made, so one of the branches is all that is left of this.
    as_number = raw.try_cast("decimal(38,10)").eqNullSafe(F.lit(number).cast("decimal(38,10)"))
    as_double = raw.try_cast("double").eqNullSafe(F.lit(float(number)))
    kind = F.typeof(raw)
    return F.when(kind.isin("float", "double"), as_double).when(kind.rlike(_EXACT), as_number).otherwise(spelled)


_EXACT = "^(tinyint|smallint|int|bigint|decimal.*)$"


def _number(text: str) -> str | None:
    """The text, if it is a number that a number column can be compared with."""
    try:
        value = Decimal(text.strip())
    except InvalidOperation:
        return None
    return text.strip() if value.is_finite() and abs(value) < 10**28 else None


def _among(raw: Column, values: Iterable[Any], ignore_case: bool) -> Column:
    """Texts in one list, other literals, and texts that are numbers, one by one; null is never among them."""
    values = [v for v in values if v is not None]
    plain = [v for v in values if isinstance(v, str) and (ignore_case or _number(v) is None)]
    texts = [_fold(v, ignore_case) for v in plain]
    text = raw.cast("string")
    tests = [(F.lower(text) if ignore_case else text).isin(texts)] if texts else []
    tests += [_same(raw, v, ignore_case) for v in values if v not in plain or not isinstance(v, str)]
    return raw.isNotNull() & reduce(operator.or_, tests, F.lit(False))


def predicate(spec: dict[str, Any]) -> Column:
    """Condition for one ``{column, op, value | values, case_insensitive}``; an unknown op is an error.

    The result may be NULL where the tested column is; ``condition`` turns that into "no match".
    """
    op = str(spec["op"]).lower()
    ignore_case = bool(spec.get("case_insensitive", False))
    raw = F.col(spec["column"])
    tested = F.lower(raw) if ignore_case else raw

    if op == "equals":
        return _same(raw, spec["value"], ignore_case)
    if op == "regex":
        return raw.cast("string").rlike(str(spec["value"]))
    if op in ("contains", "startswith", "endswith"):
        return getattr(tested.cast("string"), op)(F.lit(_fold(str(spec["value"]), ignore_case)))
    if op == "in":
        return _among(raw, spec["values"], ignore_case)
    number = raw.try_cast("double")
    if op in _NUMERIC:
        return _NUMERIC[op](number, F.lit(float(spec["value"])))
    if op == "between":
        low, high = spec["values"]
        return number.between(F.lit(float(low)), F.lit(float(high)))
    raise ValueError(f"unknown rule operator: {op!r}; known are {', '.join(OPERATORS)}")


def condition(rule: dict[str, Any]) -> Column:
    """All (default) or any of a rule's predicates. No predicate at all means every row. Never NULL."""
    tests = [predicate(p) for p in rule.get("match") or []]
    if not tests:
        return F.lit(True)
    join = operator.or_ if str(rule.get("logic") or "all").lower() == "any" else operator.and_
    return F.coalesce(reduce(join, tests), F.lit(False))


def columns_read(rule: dict[str, Any]) -> set[str]:
    return {p["column"] for p in rule.get("match") or []}
