"""Priority rules: ascending priority, later rules overwrite, a stopping rule hides its rows from later ones.

Rules become one projection for each *wave*. A wave evaluates its conditions once into an array of flags
and picks, for each target, the value of the last matching rule. A new wave starts only when a condition
reads a column that an earlier rule of the wave has written, so plans stay as short as the rules allow.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from decimal import Decimal, InvalidOperation
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.operators.predicates import columns_read, condition

_FLAGS, _STOPPED, _LIMIT = "__wave_flags", "__stopped", "__wave_limit"


@dataclass
class _Wave:
    conditions: list[Column] = field(default_factory=list)
    # (condition number, target, value), in the order of writing; target None marks a stop
    writes: list[tuple[int, str | None, Any]] = field(default_factory=list)
    written: set[str] = field(default_factory=set)


def sort_rules(rules: list[dict[str, Any]]) -> list[dict[str, Any]]:
    return sorted(rules, key=lambda r: (int(r.get("priority", 1000)), str(r.get("id", "zzz"))))


def _sets(rule: dict[str, Any]) -> list[dict[str, Any]]:
    return [a["set"] for a in rule.get("actions") or [] if a.get("set")]


def _applies(rule: dict[str, Any], profile: str | None, profile_column: str | None) -> Column | None:
    """The rule's condition with its profile scope, or None for a rule that cannot apply here."""
    scope = rule.get("profiles")
    if scope and profile is not None:
        return condition(rule) if profile in scope else None
    if scope and profile_column is not None:
        return condition(rule) & F.coalesce(F.col(profile_column).isin(list(scope)), F.lit(False))
    return condition(rule)


def _waves(rules, profile, profile_column) -> list[_Wave]:
    waves = [_Wave()]
    for rule in rules:
        applies = _applies(rule, profile, profile_column)
        if applies is None:
            continue
        reads = columns_read(rule)
        if rule.get("profiles") and profile is None and profile_column is not None:
            reads = reads | {profile_column}
        writes: list[tuple[str | None, Any]] = [(s["target"], s["value"]) for s in _sets(rule)]
        if rule.get("stop_after_match", False):
            writes.append((None, True))
        number = None
        for target, value in writes:
            if reads & waves[-1].written:
                waves.append(_Wave())
                number = None
            wave = waves[-1]
            if number is None:
                number = len(wave.conditions)
                wave.conditions.append(applies)
            wave.writes.append((number, target, value))
            if target is not None:
                wave.written.add(target)
    return [w for w in waves if w.writes]


def _natural_type(values: list[Any]) -> T.DataType:
    """Type of a new target column: the common type of the literals written to it."""
    if all(isinstance(v, bool) for v in values):
        return T.BooleanType()
    if all(isinstance(v, int) and not isinstance(v, bool) for v in values):
        return T.LongType() if any(abs(v) > 2**31 - 1 for v in values) else T.IntegerType()
    if all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in values):
        return T.DoubleType()
    return T.StringType()


def _fits(value: Any, kind: T.DataType) -> bool:
    """Whether a column of the type can hold the literal, so that no row makes the job fail."""
    if value is None or isinstance(kind, T.StringType):
        return True
    if isinstance(kind, T.BooleanType):
        return isinstance(value, bool) or str(value).lower() in ("true", "false")
    if isinstance(value, bool):
        return False
    if isinstance(kind, T.DateType):
        try:
            return isinstance(value, str) and bool(date.fromisoformat(value))
        except ValueError:
            return False
    if not isinstance(kind, T.NumericType):
        return False
    try:
        number = Decimal(str(value).strip())
    except InvalidOperation:
        return False
    if not number.is_finite() or isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return number.is_finite()
    if isinstance(kind, T.DecimalType):
        return abs(number) < Decimal(10) ** (kind.precision - kind.scale)
    bits = {T.ByteType: 7, T.ShortType: 15, T.IntegerType: 31}.get(type(kind), 63)
    return number == int(number) and -(1 << bits) <= number < 1 << bits


def apply_priority_rules(
    df: DataFrame,
    rules: list[dict[str, Any]],
    profile: str | None = None,
    profile_column: str | None = "profile_id",
) -> DataFrame:
    """Apply rules in (priority, id) order.

    A rule with ``profiles`` applies to those profiles only: to the one named by ``profile`` if all rows are
    of one profile, else by ``profile_column`` row by row, so one pass serves every profile. With both None,
    scopes are ignored. A set that its column's type can't hold is an error that names the rule, before any job.
    """
    ordered = sort_rules(rules)
    if profile_column is not None and profile_column not in df.columns:
        profile_column = None

    literals: dict[str, list[Any]] = {}
    for rule in ordered:
        for s in _sets(rule):
            literals.setdefault(s["target"], []).append(s["value"])
    kinds = {t: df.schema[t].dataType if t in df.columns else _natural_type(v) for t, v in literals.items()}
    new = [t for t in literals if t not in df.columns]
    misfits = [
        f"rule {rule.get('id')}: {s['value']!r} does not fit {s['target']} ({kinds[s['target']].simpleString()})"
        for rule in ordered for s in _sets(rule) if not _fits(s["value"], kinds[s["target"]])
    ]
    if misfits:
        raise ValueError("; ".join(misfits))

    waves = _waves(ordered, profile, profile_column)
    stops = any(target is None for w in waves for _, target, _ in w.writes)
    columns = [*df.columns, *new]
    state = df.select(
        *df.columns,
        *[F.lit(None).cast(kinds[t]).alias(t) for t in new],
        *([F.lit(False).alias(_STOPPED)] if stops else []),
    )

    for wave in waves:
        state = state.select("*", F.array(*wave.conditions).alias(_FLAGS))
        hit = [F.get(F.col(_FLAGS), F.lit(i)) for i in range(len(wave.conditions))]
        effective = hit
        if stops:
            # Number of the last rule of this wave that may still act on the row.
            limit = F.when(F.col(_STOPPED), F.lit(-1))
            for number in [n for n, target, _ in wave.writes if target is None]:
                limit = limit.when(hit[number], F.lit(number))
            state = state.select("*", limit.otherwise(F.lit(len(hit))).alias(_LIMIT))
            effective = [h & (F.col(_LIMIT) >= n) for n, h in enumerate(hit)]

        picks: dict[str, Column] = {}
        for number, target, value in reversed(wave.writes):
            if target is not None:
                literal = F.lit(value).cast(kinds[target])
                chain = picks.get(target, F)
                picks[target] = chain.when(effective[number], literal)
        values = {t: pick.otherwise(F.col(t)) for t, pick in picks.items()}
        state = state.select(
            *[values.get(c, F.col(c)).alias(c) for c in columns],
            *([(F.col(_LIMIT) < F.lit(len(hit))).alias(_STOPPED)] if stops else []),
        )
    return state.select(*columns)
