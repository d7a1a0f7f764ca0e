"""First-match categorization by large rule sets: an inverted index finds the few rules that can match a text.

``first_match`` tests every pattern on every row, which is right for some dozens of rules. For thousands:

1. from each pattern the literals are taken of which any match must hold one (``(?i)\\bhot (ring|plate)s?\\b``: ``hot ``);
2. the rarest three-letter piece of each literal goes into an index: piece, literal, pattern, rule;
3. every *distinct* text is cut into its three-letter pieces, and these meet the index in an equi-join. Only where
   the whole literal stands in the text, the pattern itself is tested;
4. the matching rules of a text are joined back to its rows, and labels are read from them.

Patterns without a literal of three letters (``^\\d+$``) are tested on every distinct text. The result is that of ``categorize``.

Texts are compared with literals in lower case and only ASCII letters count, so case-insensitive patterns are found, too.
The index has as many rows as the rules have literals; whether it is broadcast is left to Catalyst and its size check. A
text that a large share of the rows has is split by adaptive execution's skew join; its other side has one row a text.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.operators.first_match import LABELS, incoming_labels, stamp_of, with_ids

PIECE = 3
_INDEX = "piece string, literal string, pattern string, rule int"


# ------------------------------------------------------------------------------------------------ literals


def needed_literals(pattern: str) -> list[str] | None:
    """Lower-case ASCII texts of which every match of the pattern holds at least one; None if there is no saying.

    Reads the common part of the pattern language; anything it does not know ends a literal or gives None, never a wrong one.
    """
    flags = re.match(r"\(\?([a-z]*)\)", pattern)
    if re.search(r"\\Q|\(\?[a-z-]*[xu]", pattern):  # quoting, comments, letters equal beyond lower case
        return None
    found, end = _alternatives(pattern, flags.end() if flags else 0)
    return found if end == len(pattern) else None


def _best(found: list[list[str]]) -> list[str] | None:
    """The one of several needs whose shortest literal is longest."""
    usable = [f for f in found if f and min(map(len, f)) >= PIECE]
    return max(usable, key=lambda f: min(map(len, f))) if usable else None


def _alternatives(p: str, at: int) -> tuple[list[str] | None, int]:
    """Needs of ``a|b|c`` up to its closing parenthesis or the end."""
    branches = []
    while True:
        need, at = _sequence(p, at)
        branches.append(need)
        if at >= len(p) or p[at] != "|":
            break
        at += 1
    whole = None if None in branches else sorted({x for b in branches for x in b})
    return whole, at


def _sequence(p: str, at: int) -> tuple[list[str] | None, int]:
    found: list[list[str]] = []
    run = ""

    def cut() -> None:
        nonlocal run
        found.append([run])
        run = ""

    while at < len(p) and p[at] not in "|)":
        c = p[at]
        letter, need = None, None
        if c == "(":
            inside = at + 1
            if p.startswith("?", inside):
                named = re.compile(r"\?:|\?<[A-Za-z]\w*>").match(p, inside)
                if named is None:  # look-around, inline flags
                    cut()
                    at = _closed(p, at)
                    at, _ = _quantifier(p, at)
                    continue
                inside = named.end()
            need, at = _alternatives(p, inside)
            at += 1  # the closing parenthesis
        elif c == "[":
            at = _class_end(p, at)
        elif c == "\\":
            after = p[at + 1 : at + 2]
            if after and not after.isalnum():
                letter = after
            at += 2 if after not in ("x", "u", "p", "P", "k", "0", "c", "N") else len(p)  # escapes with arguments: read no further
            if at >= len(p) and after in ("x", "u", "p", "P", "k", "0", "c", "N"):
                cut()
                return None, len(p) + 1
        elif c in ".^$":
            at += 1
        else:
            letter = c
            at += 1
        start = at
        at, least = _quantifier(p, at)
        if letter is not None and letter.isascii():
            if least:
                run += letter.lower()
            if at != start:
                cut()
        else:
            cut()
            if need and least:
                found.append(need)
    cut()
    return _best(found), at


def _quantifier(p: str, at: int) -> tuple[int, bool]:
    """Behind a quantifier, if there is one, and whether at least one repetition is asked for."""
    m = re.compile(r"(?:[?*+]|\{(\d+)(?:,\d*)?\})[?+]?").match(p, at)
    if not m:
        return at, True
    return m.end(), p[at] == "+" or (m[1] is not None and int(m[1]) > 0)


def _class_end(p: str, at: int) -> int:
    depth = 0
    while at < len(p):
        if p[at] == "\\":
            at += 1
        elif p[at] == "[":
            depth += 1
            if p[at + 1 : at + 3] == "^]" or p[at + 1 : at + 2] == "]":
                at += 2 if p[at + 1] == "^" else 1
        elif p[at] == "]":
            depth -= 1
            if not depth:
                return at + 1
        at += 1
    return len(p) + 1


def _closed(p: str, at: int) -> int:
    """Behind the parenthesis that closes the one at ``at``."""
    depth = 0
    while at < len(p):
        if p[at] == "\\":
            at += 1
        elif p[at] == "[":
            at = _class_end(p, at) - 1
        elif p[at] == "(":
            depth += 1
        elif p[at] == ")":
            depth -= 1
            if not depth:
                return at + 1
        at += 1
    return len(p) + 1


# --------------------------------------------------------------------------------------------------- index


def index_rows(patterns: dict[int, str]) -> tuple[list[tuple[str, str, str, int]], dict[int, str]]:
    """Rows of the index, and the patterns that have no place in it."""
    needs = {i: needed_literals(p) for i, p in patterns.items()}
    pieces = {x: {x[k : k + PIECE] for k in range(len(x) - PIECE + 1)} for need in needs.values() for x in need or ()}
    uses = Counter(piece for need in needs.values() for x in need or () for piece in pieces[x])
    rows = [
        (min(pieces[x], key=lambda piece: (uses[piece], piece)), x, patterns[i], i)
        for i, need in needs.items() for x in need or ()
    ]
    return rows, {i: p for i, p in patterns.items() if needs[i] is None}


def matching_rules(texts: DataFrame, patterns: dict[int, str]) -> DataFrame:
    """text, hits (ascending numbers of the patterns that match) for the distinct, non-null ``text`` that any matches."""
    rows, broad = index_rows(patterns)
    found = []
    if rows:
        index = texts.sparkSession.createDataFrame(rows, _INDEX)
        low = F.lower("text")
        cut = texts.select("text", F.explode(F.array_distinct(F.regexp_extract_all(low, F.lit(f"(?s)(?=(.{{{PIECE}}}))"), F.lit(1)))).alias("piece"))
        met = cut.join(index, "piece").where(low.contains(F.col("literal"))).where(F.expr("text rlike pattern"))
        found.append(met.select("text", "rule"))
    if broad:
        flags = F.array(*[F.when(F.col("text").rlike(p), F.lit(i)) for i, p in broad.items()])
        found.append(texts.select("text", F.explode(F.array_compact(flags)).alias("rule")))
    if not found:
        return texts.limit(0).select("text", F.array().cast("array<int>").alias("hits"))
    both = found[0] if len(found) == 1 else found[0].union(found[1])
    return both.groupBy("text").agg(F.array_sort(F.collect_set("rule")).alias("hits"))


# -------------------------------------------------------------------------------------------------- labels


def categorize_indexed(df: DataFrame, rules: list[dict[str, Any]], keep_existing: bool = True) -> DataFrame:
    """As ``first_match.categorize``, for any number of rules. ``df`` is read twice, the first time only the tested columns."""
    rules = with_ids(rules)
    others = [c for c in df.columns if c not in LABELS]
    labelled = df.select(*others, *incoming_labels(df, keep_existing))
    by_column: dict[str, dict[int, str]] = {}
    for i, r in enumerate(rules):
        by_column.setdefault(r.get("column") or "name", {})[i] = r["value"]
    if not rules:
        return labelled

    none = F.array().cast("array<int>")
    lists = []
    for k, (column, patterns) in enumerate(by_column.items()):
        text = F.col(column).cast("string")
        texts = df.select(text.alias("text")).where("text IS NOT NULL").distinct()
        hits = matching_rules(texts, patterns).select(F.col("text").alias(f"__text{k}"), F.col("hits").alias(f"__hits{k}"))
        labelled = labelled.join(hits, text == F.col(f"__text{k}"), "left")
        lists.append(F.coalesce(f"__hits{k}", none))
    flagged = labelled.select(*others, *LABELS, F.array_sort(F.concat(*lists)).alias("__hits"))
    return _labels_from_hits(flagged, others, rules)


def _labels_from_hits(flagged: DataFrame, others: list[str], rules: list[dict[str, Any]]) -> DataFrame:
    # One constant for all rules, read by position.
    facts = [{"id": r["id"], "category": r.get("category"), "subcategory": r.get("subcategory"), "stamp": stamp_of(r)} for r in rules]
    table = F.from_json(F.lit(json.dumps(facts)), "array<struct<id:string,category:string,subcategory:string,stamp:string>>")

    def of(i: Column, name: str) -> Column:
        return F.get(table, i)[name]

    hits = F.col("__hits")
    first = F.get(hits, F.lit(0))
    decisive = F.get(F.filter(hits, lambda i: of(i, "category").isNotNull()), F.lit(0))
    is_open = F.col("category").isNull() & first.isNotNull()
    category = F.coalesce(F.col("category"), F.when(is_open, of(decisive, "category")))
    early = F.filter(hits, lambda i: of(i, "category").isNull() & of(i, "subcategory").isNotNull() & (F.col("__decisive").isNull() | (i < F.col("__decisive"))))
    fill = F.filter(hits, lambda i: of(i, "subcategory").isNotNull() & (of(i, "category") == F.col("__category")))
    staged = flagged.select(*others, *LABELS, "__hits", decisive.alias("__decisive"), category.alias("__category"))
    subcategory = F.coalesce(
        F.when(is_open, of(F.col("__decisive"), "subcategory")),
        F.when(is_open, of(F.element_at(F.concat(F.array(F.lit(-1)), early), -1), "subcategory")),
        F.col("subcategory"),
        of(F.get(fill, F.lit(0)), "subcategory"),
    )
    none_yet = F.coalesce(F.col("applied_rules"), F.array().cast("array<string>"))
    trail = F.when(first.isNotNull(), F.array_union(none_yet, F.transform(hits, lambda i: of(i, "id")))).otherwise(F.col("applied_rules"))
    return staged.select(
        *others,
        F.col("__category").alias("category"),
        subcategory.alias("subcategory"),
        trail.alias("applied_rules"),
        F.coalesce(F.col("operation"), F.when(is_open, of(first, "stamp"))).alias("operation"),
    )
