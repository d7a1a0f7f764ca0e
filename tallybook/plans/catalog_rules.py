"""Queries over both rule engines, rule files and rule tables, each with the SQL it must agree with."""

from __future__ import annotations

import json
from importlib.util import find_spec
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.operators import rule_checks
from tallybook.operators.first_match import categorize
from tallybook.operators.predicates import condition
from tallybook.operators.priority import apply_priority_rules
from tallybook.operators.rule_index import categorize_indexed
from tallybook.operators.rule_tables import normalize_rules
from tallybook.plans.scratch import shared_folder
from tallybook.plans.testbed import (
    FACTS_SQL,
    SHOP_RULES,
    SILVER_SQL,
    categorized_sql,
    plain,
    silver,
    table,
    text_sql,
)
from tallybook.schemas import GENERIC_RULE
from tallybook.sources.rules import generic_rules, latest_rules, load_generic_rules, load_rules_yaml, load_simple_rules, simple_rules

# ------------------------------------------------------------------------------------------ first match

LABELS = ("txn_id", "profile_id", "category", "subcategory", "applied_rules", "operation")


def categorize_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = categorize(silver(spark, sf_dir), SHOP_RULES)
    return labelled.select("txn_id", "profile_id", "category", "operation")


def categorize_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each combination of rules applies."""
    trail = plain(categorize(silver(spark, sf_dir), SHOP_RULES).select("applied_rules", "amount"))
    return trail.groupBy("applied_rules").agg(F.count("*").alias("n"))


def _prelabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of some accounts arrive with a category, and some of those with an operation and a trail."""
    preset = F.col("account_id").rlike("[35]$")
    return silver(spark, sf_dir).withColumns({
        "category": F.when(preset, F.when(F.col("account_id").endswith("3"), "Metal").otherwise("Machines")),
        "operation": F.when(F.col("account_id").endswith("35"), F.lit("manual")),
        "applied_rules": F.when(preset, F.array(F.lit("manual"), F.lit("machines"))),
        "subcategory": F.when(F.col("account_id").endswith("13"), F.lit("Given")),
    })


def categorize_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(categorize(_prelabelled(spark, sf_dir), SHOP_RULES).select(*LABELS))


def _backfill_sql() -> str:
    first = {
        c: "CASE " + " ".join(f"WHEN m{i} THEN {text_sql(v(r))}" for i, r in enumerate(SHOP_RULES)) + " END"
        for c, v in (
            ("category", lambda r: r["category"]),
            ("subcategory", lambda r: r.get("subcategory")),
            ("operation", lambda r: f"set_category:{r['id']}:{r['category']}"
             + (f"/{r['subcategory']}" if r.get("subcategory") else "")),
        )
    }
    fill = "CASE " + " ".join(
        f"WHEN m{i} AND category = {text_sql(r['category'])} THEN {text_sql(r['subcategory'])}"
        for i, r in enumerate(SHOP_RULES) if r.get("subcategory")
    ) + " END"
    ids = [r["id"] for r in SHOP_RULES]
    hits = ", ".join(f"CASE WHEN m{i} THEN '{rid}' END" for i, rid in enumerate(ids))
    # 'machines' may be in the incoming trail already and is not added twice
    new_hits = ", ".join(f"CASE WHEN m{i} THEN '{rid}' END" for i, rid in enumerate(ids) if rid != "machines")
    flags = ", ".join(
        f"regexp_matches({r.get('column', 'name')}, {text_sql(r['value'])}) AS m{i}" for i, r in enumerate(SHOP_RULES)
    )
    return f"""WITH {SILVER_SQL},
pre AS (SELECT *, regexp_matches(account_id, '[35]$') AS preset,
    CASE WHEN account_id LIKE '%3' THEN 'Metal' WHEN account_id LIKE '%5' THEN 'Machines' END AS old_category,
    CASE WHEN account_id LIKE '%35' THEN 'manual' END AS old_operation,
    CASE WHEN account_id LIKE '%13' THEN 'Given' END AS old_sub FROM silver),
flagged AS (SELECT *, {flags} FROM pre),
set_first AS (SELECT *, coalesce(old_category, {first["category"]}) AS category,
    CASE WHEN old_category IS NULL THEN coalesce({first["subcategory"]}, old_sub) ELSE old_sub END AS sub,
    CASE WHEN old_category IS NULL THEN {first["operation"]} END AS stamp FROM flagged)
SELECT txn_id, profile_id, category, coalesce(sub, {fill}) AS subcategory,
  CASE WHEN preset THEN concat_ws(',', 'manual', 'machines', {new_hits}) ELSE nullif(concat_ws(',', {hits}), '') END
    AS applied_rules,
  coalesce(old_operation, stamp) AS operation
FROM set_first"""


def _rule_folder(spark: SparkSession, rules: list[dict[str, Any]], head: str = "") -> str:
    """Rules as one file of JSON lines on shared storage."""
    folder = shared_folder(spark, "rules")
    text = "\n".join([head, "", *[json.dumps(r) for r in rules]])
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(folder)
    return folder


def categorize_rule_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules read from files, then applied."""
    shown = [{"description": r["id"], "op": "regex", **r} for r in SHOP_RULES]
    rules = load_simple_rules(spark, _rule_folder(spark, shown, "# shop rules"), "*.txt")
    return plain(categorize(silver(spark, sf_dir), rules).select(*LABELS))


def part_rules(spark: SparkSession, sf_dir: str) -> list[dict[str, Any]]:
    """Two kinds of rules, well over a thousand: one for each name and brand of the parts, one for each kind of thing and brand."""
    pairs = table(spark, sf_dir, "part").select("p_name", "p_brand").distinct().orderBy("p_name", "p_brand").collect()
    exact = [
        {"id": f"a:{r.p_name}:{r.p_brand}", "value": rf"^\s*{r.p_name}\s+{r.p_brand}$", "category": r.p_name.split()[-1],
         "subcategory": None if r.p_name.split()[0] in ("red", "blue") else r.p_name.split()[0]}
        for r in pairs
    ]
    kinds = sorted({(r.p_name.split()[-1], r.p_brand) for r in pairs})
    broad = [
        {"id": f"b:{kind}:{brand}", "value": rf"(?i)\b{kind.upper()}\b.*{brand}\b", "category": kind, "subcategory": brand}
        for kind, brand in kinds
    ]
    return [*exact, *broad]


def categorize_many_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = categorize_indexed(silver(spark, sf_dir), part_rules(spark, sf_dir))
    return plain(labelled.select("txn_id", "profile_id", "category", "subcategory", "applied_rules", "operation"))


_MANY_SQL = f"""WITH {SILVER_SQL}, words AS (
  SELECT *, split_part(trim(description), ' ', 1) AS head, split_part(trim(description), ' ', 2) AS kind, regexp_extract(description, 'Brand#\\d+') AS brand FROM silver),
r AS (SELECT *, 'a:' || head || ' ' || kind || ':' || brand AS a, CASE WHEN head NOT IN ('red', 'blue') THEN head END AS sub FROM words)
SELECT txn_id, profile_id, kind AS category, coalesce(sub, brand) AS subcategory, a || ',b:' || kind || ':' || brand AS applied_rules,
  'set_category:' || a || ':' || kind || coalesce('/' || sub, '') AS operation FROM r"""

_LABELS_SQL = f"WITH {SILVER_SQL}{categorized_sql()} SELECT txn_id, profile_id, {{}} FROM categorized"

# ------------------------------------------------------------------------------------------ predicates

# Per query: named rules and the SQL condition of each.
PREDICATES: dict[str, list[tuple[str, dict[str, Any], str]]] = {
    "pred_equals": [
        ("exact", {"match": [{"column": "profile_id", "op": "equals", "value": "A"}]}, "profile_id = 'A'"),
        ("folded", {"match": [{"column": "profile_id", "op": "equals", "value": "n", "case_insensitive": True}]},
         "lower(profile_id) = 'n'"),
        ("missing", {"match": [{"column": "merchant", "op": "equals", "value": None}]}, "merchant IS NULL"),
        ("against_null", {"match": [{"column": "merchant", "op": "equals", "value": "x"}]}, "FALSE"),
        ("number", {"match": [{"column": "month", "op": "equals", "value": 7}]}, "month = 7"),
        ("flag", {"match": [{"column": "is_transfer", "op": "equals", "value": False}]}, "TRUE"),
        ("text_on_number", {"match": [{"column": "month", "op": "equals", "value": "07"}]}, "month = 7"),
        ("text_on_decimal", {"match": [{"column": "amount", "op": "equals", "value": "-12000"}]}, "amount = -12000"),
        ("text_on_text", {"match": [{"column": "account_id", "op": "equals", "value": "07"}]}, "account_id = '07'"),
        ("word_on_number", {"match": [{"column": "month", "op": "equals", "value": "July"}]}, "FALSE"),
    ],
    "pred_contains": [
        ("exact", {"match": [{"column": "name", "op": "contains", "value": "widget"}]}, "name LIKE '%widget%'"),
        ("folded", {"match": [{"column": "name", "op": "contains", "value": "BRAND#1", "case_insensitive": True}]},
         "lower(name) LIKE '%brand#1%'"),
        ("cased", {"match": [{"column": "name", "op": "contains", "value": "BRAND"}]}, "name LIKE '%BRAND%'"),
        ("literal", {"match": [{"column": "name", "op": "contains", "value": "#2."}]}, "name LIKE '%#2.%'"),
        ("in_number", {"match": [{"column": "amount", "op": "contains", "value": "99."}]},
         "CAST(amount AS VARCHAR) LIKE '%99.%'"),
    ],
    "pred_regex": [
        ("find", {"match": [{"column": "name", "op": "regex", "value": r"r(ed|od)\b"}]}, r"regexp_matches(name, 'r(ed|od)\b')"),
        ("flagged", {"match": [{"column": "name", "op": "regex", "value": r"(?i)^\s+COLD.*#\d{2}$"}]},
         r"regexp_matches(name, '(?i)^\s+COLD.*#\d{2}$')"),
        ("ci_is_ignored", {"match": [{"column": "name", "op": "regex", "value": "RED", "case_insensitive": True}]},
         "regexp_matches(name, 'RED')"),
        ("on_null", {"match": [{"column": "merchant", "op": "regex", "value": ".*"}]}, "FALSE"),
    ],
    "pred_startswith": [
        ("exact", {"match": [{"column": "account_id", "op": "startswith", "value": "ACC-1"}]}, "starts_with(account_id, 'ACC-1')"),
        ("folded", {"match": [{"column": "clean_desc", "op": "startswith", "value": " OLD", "case_insensitive": True}]},
         "starts_with(clean_desc, ' old')"),
        ("untrimmed", {"match": [{"column": "name", "op": "startswith", "value": "old"}]}, "starts_with(name, 'old')"),
    ],
    "pred_endswith": [
        ("exact", {"match": [{"column": "name", "op": "endswith", "value": "#7"}]}, "suffix(name, '#7')"),
        ("folded", {"match": [{"column": "name", "op": "endswith", "value": "BRAND#11", "case_insensitive": True}]},
         "suffix(lower(name), 'brand#11')"),
    ],
    "pred_in": [
        ("exact", {"match": [{"column": "account_id", "op": "in", "values": ["ACC-1", "ACC-22", "acc-3"]}]},
         "account_id IN ('ACC-1', 'ACC-22')"),
        ("folded", {"match": [{"column": "account_id", "op": "in", "values": ["ACC-1", "acc-3"], "case_insensitive": True}]},
         "account_id IN ('ACC-1', 'ACC-3')"),
        ("on_null", {"match": [{"column": "merchant", "op": "in", "values": ["x"]}]}, "FALSE"),
        ("text_on_number", {"match": [{"column": "month", "op": "in", "values": ["1", "02.0", "May", 6]}]}, "month IN (1, 2, 6)"),
    ],
    "pred_compare": [
        ("gt", {"match": [{"column": "amount", "op": "gt", "value": 0}]}, "amount > 0"),
        ("gte", {"match": [{"column": "month", "op": "gte", "value": 11}]}, "month >= 11"),
        ("lt", {"match": [{"column": "amount", "op": "lt", "value": -50000.5}]}, "amount < -50000.5"),
        ("lte", {"match": [{"column": "month", "op": "lte", "value": 2}]}, "month <= 2"),
        ("not_a_number", {"match": [{"column": "name", "op": "gt", "value": 0}]}, "FALSE"),
    ],
    "pred_between": [
        ("amounts", {"match": [{"column": "amount", "op": "between", "values": [1000, 2000.5]}]}, "amount BETWEEN 1000 AND 2000.5"),
        ("ends", {"match": [{"column": "month", "op": "between", "values": [3, 5]}]}, "month IN (3, 4, 5)"),
    ],
    "pred_any_all": [
        ("all_default", {"match": [
            {"column": "amount", "op": "gt", "value": 0}, {"column": "name", "op": "contains", "value": "red"},
        ]}, "amount > 0 AND name LIKE '%red%'"),
        ("any", {"logic": "any", "match": [
            {"column": "merchant", "op": "contains", "value": "x"}, {"column": "name", "op": "contains", "value": "red"},
        ]}, "name LIKE '%red%'"),
        ("null_blocks_all", {"logic": "all", "match": [
            {"column": "merchant", "op": "contains", "value": "x"}, {"column": "name", "op": "contains", "value": "red"},
        ]}, "FALSE"),
        ("no_predicate", {"match": []}, "TRUE"),
    ],
}


def _predicate_query(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        counts = [F.count_if(condition(rule)).alias(label) for label, rule, _ in PREDICATES[name]]
        return silver(spark, sf_dir).groupBy("profile_id", "year").agg(*counts)

    counts = ", ".join(f"count(*) FILTER (WHERE {sql}) AS {label}" for label, _, sql in PREDICATES[name])
    return run, f"WITH {SILVER_SQL} SELECT profile_id, year, {counts} FROM silver GROUP BY ALL"


# ------------------------------------------------------------------------------------------ priority rules


def _set(target: str, value: Any) -> dict[str, Any]:
    return {"set": {"target": target, "value": value}}


OVERWRITE_RULES = [
    {"id": "late", "priority": 30, "match": [{"column": "name", "op": "contains", "value": "red"}],
     "actions": [_set("category", "Red"), _set("merchant", "Paint Shop")]},
    {"id": "early", "priority": 10, "match": [{"column": "name", "op": "regex", "value": "rod|ring"}],
     "actions": [_set("category", "Shapes")]},
    {"id": "b-same", "priority": 20, "match": [{"column": "amount", "op": "lt", "value": -90000}],
     "actions": [_set("category", "Large")]},
    {"id": "a-same", "priority": 20, "match": [{"column": "amount", "op": "lt", "value": -80000}],
     "actions": [_set("category", "Big")]},
    {"id": "no-priority", "match": [{"column": "category", "op": "equals", "value": "Large"}],
     "actions": [_set("merchant", "Head Office")]},
]
STOP_RULES = [
    {"id": "s1", "priority": 1, "match": [{"column": "name", "op": "contains", "value": "ring"}],
     "actions": [_set("category", "Ring")], "stop_after_match": True},
    {"id": "s2", "priority": 2, "match": [{"column": "name", "op": "contains", "value": "blue"}],
     "actions": [_set("category", "Blue"), _set("merchant", "Sky")]},
    {"id": "s3", "priority": 3, "match": [{"column": "category", "op": "equals", "value": "Blue"},
                                          {"column": "amount", "op": "gt", "value": 0}],
     "actions": [_set("merchant", "Sky In")], "stop_after_match": True},
    {"id": "s4", "priority": 4, "match": [], "actions": [_set("is_transfer", True)]},
]
SCOPE_RULES = [
    {"id": "p1", "priority": 1, "match": [{"column": "name", "op": "contains", "value": "gear"}],
     "actions": [_set("category", "Gears")]},
    {"id": "p2", "priority": 2, "profiles": ["A", "R"], "match": [{"column": "name", "op": "contains", "value": "old"}],
     "actions": [_set("category", "Old")]},
    {"id": "p3", "priority": 3, "profiles": ["N"], "actions": [_set("merchant", "N only")], "stop_after_match": True},
    {"id": "p4", "priority": 4, "actions": [_set("is_transfer", True)]},
]
MULTI_SET_RULES = [
    {"id": "m1", "priority": 1, "logic": "any", "match": [
        {"column": "name", "op": "endswith", "value": "#1"}, {"column": "amount", "op": "between", "values": [10000, 20000]}],
     "actions": [_set("note", "seen"), _set("score", 5), _set("weight", 0.5), _set("is_transfer", True)]},
    {"id": "m2", "priority": 2, "match": [{"column": "score", "op": "gte", "value": 5},
                                          {"column": "name", "op": "contains", "value": "hot"}],
     "actions": [_set("score", 9), _set("note", "hot")]},
]
RULE_OUTPUT = ("txn_id", "profile_id", "category", "merchant", "is_transfer")


def _priority_query(rules: list[dict[str, Any]], extra: tuple[str, ...] = ()):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return apply_priority_rules(silver(spark, sf_dir), rules).select(*RULE_OUTPUT, *extra)

    return run


def rules_load_generic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priority rules read from files (one id written twice), then applied."""
    files = [{"logic": "all", "priority": 1000, **r} for r in OVERWRITE_RULES]
    stale = {**files[0], "match": [], "actions": [_set("category", "stale")]}
    rules = load_generic_rules(spark, _rule_folder(spark, [stale, *files]), "*.txt")
    return apply_priority_rules(silver(spark, sf_dir), rules).select(*RULE_OUTPUT)


_OVERWRITE_SQL = f"""WITH {SILVER_SQL}, labelled AS (
  SELECT *, CASE WHEN name LIKE '%red%' THEN 'Red' WHEN amount < -90000 THEN 'Large' WHEN amount < -80000 THEN 'Big'
    WHEN regexp_matches(name, 'rod|ring') THEN 'Shapes' END AS category FROM silver)
SELECT txn_id, profile_id, category, CASE WHEN category = 'Large' THEN 'Head Office'
  WHEN name LIKE '%red%' THEN 'Paint Shop' END AS merchant, is_transfer FROM labelled"""
_STOP_SQL = f"""WITH {SILVER_SQL}, f AS (SELECT *, name LIKE '%ring%' AS ring, name LIKE '%blue%' AS blue FROM silver)
SELECT txn_id, profile_id, CASE WHEN ring THEN 'Ring' WHEN blue THEN 'Blue' END AS category,
  CASE WHEN blue AND NOT ring AND amount > 0 THEN 'Sky In' WHEN blue AND NOT ring THEN 'Sky' END AS merchant,
  NOT ring AND NOT (blue AND amount > 0) AS is_transfer FROM f"""
_SCOPE_SQL = f"""WITH {SILVER_SQL}
SELECT txn_id, profile_id,
  CASE WHEN profile_id IN ('A', 'R') AND name LIKE '%old%' THEN 'Old' WHEN name LIKE '%gear%' THEN 'Gears' END AS category,
  CASE WHEN profile_id = 'N' THEN 'N only' END AS merchant, profile_id <> 'N' AS is_transfer FROM silver"""
_MULTI_SQL = f"""WITH {SILVER_SQL}, f AS (
  SELECT *, name LIKE '%#1' OR amount BETWEEN 10000 AND 20000 AS hit FROM silver)
SELECT txn_id, profile_id, CAST(NULL AS VARCHAR) AS category, merchant, hit AS is_transfer,
  CASE WHEN hit AND name LIKE '%hot%' THEN 'hot' WHEN hit THEN 'seen' END AS note,
  CASE WHEN hit AND name LIKE '%hot%' THEN 9 WHEN hit THEN 5 END AS score, CASE WHEN hit THEN 0.5::DOUBLE END AS weight FROM f"""

# ------------------------------------------------------------------------------------------ rule text


def rule_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line of rule text for every part: one file for each brand, some lines broken in different ways."""
    size = F.col("p_size")
    rule = {
        "id": F.concat(F.lit("rule-"), "p_name"),
        "description": F.col("p_type"),
        "op": F.when(size == 2, F.lit("contains")).otherwise(F.lit("regex")),
        "value": F.when(size == 3, F.lit("(")).when(size == 8, F.lit("(?P<kind>rod)")).otherwise(F.concat("p_name", F.lit(".*"), "p_brand")),
        "category": F.when(size != 1, F.col("p_type")),
        "subcategory": F.when(size != 6, F.col("p_brand")),
    }
    full = F.to_json(F.struct(*[v.alias(k) for k, v in rule.items()]))
    text = (
        F.when(size == 4, F.substring(full, 1, 25)).when(size == 5, F.lit("# retired"))
        .when(size == 7, F.lit("")).otherwise(full)
    )
    return table(spark, sf_dir, "part").select(
        F.concat("p_brand", F.lit(".ndjson")).alias("file"), (F.col("p_partkey") + 1).cast("int").alias("line"), text.alias("text")
    )


_RULES_CTE = """rule_rows AS (
  SELECT p_brand || '.ndjson' AS file, CAST(p_partkey + 1 AS INTEGER) AS line, p_size, 'rule-' || p_name AS id,
    CASE p_size WHEN 3 THEN '(' WHEN 8 THEN '(?P<kind>rod)' ELSE p_name || '.*' || p_brand END AS value, p_type, p_brand, p_name
  FROM part WHERE p_size NOT IN (5, 7))"""


def rule_lint_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of Python's JSON and regex checks differ between its releases and are left out."""
    faults = rule_checks.lint_errors(rule_text(spark, sf_dir))
    own_words = ~F.col("kind").isin("invalid_json", "regex_does_not_compile")
    return faults.select("file", "line", "kind", F.when(own_words, F.col("detail")).alias("detail"))


LINT_ERRORS_SQL = f"""WITH {_RULES_CTE}
SELECT file, line, kind, detail FROM (
  SELECT file, line, CASE p_size WHEN 1 THEN 'missing_field' WHEN 2 THEN 'unsupported_op'
    WHEN 3 THEN 'regex_does_not_compile' WHEN 4 THEN 'invalid_json' WHEN 6 THEN 'missing_field' WHEN 8 THEN 'regex_not_for_java' END AS kind,
    CASE p_size WHEN 1 THEN 'category' WHEN 2 THEN 'contains' WHEN 6 THEN 'subcategory' WHEN 8 THEN 'Unknown inline modifier' END AS detail FROM rule_rows)
WHERE kind IS NOT NULL"""


def rule_lint_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_checks.lint_warnings(rule_text(spark, sf_dir))


LINT_WARNINGS_SQL = f"""WITH {_RULES_CTE}, used AS (
  SELECT file, line, 'duplicate_id' AS kind, id AS value FROM rule_rows WHERE p_size <> 4
  UNION ALL SELECT file, line, 'duplicate_pattern', value FROM rule_rows WHERE p_size <> 4),
numbered AS (
  SELECT *, row_number() OVER w AS n, first_value(file) OVER w AS first_file, first_value(line) OVER w AS first_line
  FROM used WINDOW w AS (PARTITION BY kind, value ORDER BY file, line))
SELECT kind, value, file, line, first_file, first_line FROM numbered WHERE n > 1"""


def rules_load_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-match rules from text with defaults, and which lines a loader would reject."""
    rules = simple_rules(rule_text(spark, sf_dir))
    return rules.select(
        "file", "line", "id", "column", "value", "category", "subcategory", F.col("error").isNotNull().alias("is_rejected")
    )


LOAD_SIMPLE_SQL = f"""WITH {_RULES_CTE}
SELECT file, line, id, 'name' AS "column", value, CASE WHEN p_size <> 1 THEN p_type END AS category,
  CASE WHEN p_size <> 6 THEN p_brand END AS subcategory, p_size IN (2, 3, 8) AS is_rejected
FROM rule_rows WHERE p_size <> 4
UNION ALL SELECT file, line, p_brand || ':' || line, 'name', NULL, NULL, NULL, TRUE FROM rule_rows WHERE p_size = 4"""


def generic_rule_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A priority rule for every part, in the layout of rule tables."""
    name_test = {"column": F.lit("name"), "op": F.lit("contains"), "value": F.col("p_name"),
                 "values": F.lit(None).cast("array<string>"), "case_insensitive": F.lit(True)}
    price_test = {"column": F.lit("amount"), "op": F.lit("between"), "value": F.lit(None).cast("string"),
                  "values": F.array(F.lit("0"), F.col("p_retailprice").cast("decimal(10,2)").cast("string")),
                  "case_insensitive": F.lit(False)}

    def struct(fields: dict[str, Any]):
        return F.struct(*[v.alias(k) for k, v in fields.items()])

    def action(target: str, value):
        return F.struct(F.struct(F.lit(target).alias("target"), value.alias("value")).alias("set"))

    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("rule-"), "p_partkey").alias("id"),
        F.when(F.col("p_size") > 5, F.col("p_size")).alias("priority"),
        F.when(F.col("p_type") == "PROMO", "any").otherwise("all").alias("logic"),
        F.when(F.col("p_size") > 25, F.array(struct(name_test), struct(price_test)))
        .otherwise(F.array(struct(name_test))).alias("match"),
        F.array(action("category", F.col("p_type")), action("merchant", F.col("p_brand"))).alias("actions"),
        F.when(F.col("p_size") == 50, F.lit(True)).alias("stop_after_match"),
        F.when(F.col("p_type") == "SMALL", F.array(F.lit("A"), F.lit("R"))).alias("profiles"),
    ).select(*[F.col(f.name).cast(f.dataType) for f in GENERIC_RULE])


def _normalized(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return normalize_rules(generic_rule_rows(spark, sf_dir))[name]

    return run


def rules_load_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priority rules from text: rejected lines dropped, last line of each id kept."""
    part = table(spark, sf_dir, "part")
    rule = F.struct(
        F.concat(F.lit("rule-"), "p_name").alias("id"),
        F.when(F.col("p_size") != 1, F.col("p_size")).alias("priority"),
        F.when(F.col("p_size") == 2, "some").when(F.col("p_size") % 2 == 0, "ANY").otherwise("all").alias("logic"),
        F.array(F.struct(F.lit("name").alias("column"), F.lit("regex").alias("op"),
                         F.when(F.col("p_size") == 3, "[").otherwise(F.col("p_name")).alias("value"))).alias("match"),
        F.array(F.struct(F.struct(F.lit("category").alias("target"), F.col("p_type").alias("value")).alias("set"))).alias("actions"),
    )
    lines = part.select(
        F.concat("p_brand", F.lit(".ndjson")).alias("file"), (F.col("p_partkey") + 1).cast("int").alias("line"),
        F.to_json(rule).alias("text"),
    )
    good = generic_rules(lines).filter("error IS NULL")
    return latest_rules(
        good.select("file", "line", F.col("rule.id").alias("id"), "rule.priority", "rule.logic",
                    F.col("rule.actions")[0]["set"]["value"].alias("category"))
    ).orderBy("priority", "id")


def rule_lint_generic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of priority rules, a line of text for every part; of Python's own messages only the kind is shown."""
    size = F.col("p_size")
    test = F.struct(F.lit("name").alias("column"), F.lit("regex").alias("op"),
                    F.when(size == 3, "[").when(size == 5, "(?P<a>b)").otherwise(F.col("p_name")).alias("value"))
    rule = F.struct(
        F.when(size % 7 != 0, F.col("p_name")).alias("id"), F.when(size != 1, size).alias("priority"),
        F.when(size == 2, "some").otherwise("all").alias("logic"), F.array(test).alias("match"), F.array().cast("array<string>").alias("actions"),
    )
    text = F.when(size == 4, F.substring(F.to_json(rule), 1, 20)).when(size == 6, "").otherwise(F.to_json(rule))
    lines = table(spark, sf_dir, "part").select(F.concat("p_brand", F.lit(".ndjson")).alias("file"), (F.col("p_partkey") + 1).cast("int").alias("line"), text.alias("text"))
    own = F.col("detail").rlike("^(invalid JSON|regex does not compile)")
    return rule_checks.lint_generic_errors(lines).select("file", "line", F.when(own, F.substring_index("detail", ":", 1)).otherwise(F.col("detail")).alias("detail"))


LINT_GENERIC_SQL = """WITH rows AS (SELECT p_brand || '.ndjson' AS file, CAST(p_partkey + 1 AS INTEGER) AS line, p_size FROM part WHERE p_size <> 6)
SELECT file, line, 'invalid JSON' AS detail FROM rows WHERE p_size = 4
UNION ALL SELECT file, line, 'missing field: id' FROM rows WHERE p_size % 7 = 0
UNION ALL SELECT file, line, 'missing field: priority' FROM rows WHERE p_size = 1
UNION ALL SELECT file, line, 'logic must be any or all, got: some' FROM rows WHERE p_size = 2
UNION ALL SELECT file, line, 'regex does not compile' FROM rows WHERE p_size = 3
UNION ALL SELECT file, line, 'pattern is not for Java: Unknown inline modifier' FROM rows WHERE p_size = 5"""


def rules_yaml_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priority rules from a YAML file, applied."""
    path = shared_folder(spark, "rules-yaml")
    text = "rules:\n" + "".join(f"  - {json.dumps(r)}\n" for r in OVERWRITE_RULES)  # JSON values are YAML, too
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return apply_priority_rules(silver(spark, sf_dir), load_rules_yaml(path, spark)).select(*RULE_OUTPUT)


LOAD_LATEST_SQL = """WITH good AS (
  SELECT p_brand || '.ndjson' AS file, CAST(p_partkey + 1 AS INTEGER) AS line, 'rule-' || p_name AS id, p_size AS priority,
    CASE WHEN p_size % 2 = 0 THEN 'any' ELSE 'all' END AS logic, p_type AS category
  FROM part WHERE p_size NOT IN (1, 2, 3)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY file DESC, line DESC) AS n FROM good)
SELECT file, line, id, priority, logic, category FROM numbered WHERE n = 1"""

QUERIES = {
    "categorize_first_match": (categorize_first_match, _LABELS_SQL.format("category, operation")),
    "categorize_audit": (
        categorize_audit,
        f"WITH {FACTS_SQL} SELECT applied_rules, count(*) AS n FROM facts GROUP BY applied_rules",
    ),
    "categorize_backfill": (categorize_backfill, _backfill_sql()),
    "categorize_rule_table": (
        categorize_rule_table, _LABELS_SQL.format("category, subcategory, applied_rules, operation")
    ),
    "categorize_many_rules": (categorize_many_rules, _MANY_SQL),
    **{name: _predicate_query(name) for name in PREDICATES},
    "rules_priority_overwrite": (_priority_query(OVERWRITE_RULES), _OVERWRITE_SQL),
    "rules_stop_after_match": (_priority_query(STOP_RULES), _STOP_SQL),
    "rules_profile_scope": (_priority_query(SCOPE_RULES), _SCOPE_SQL),
    "rules_multi_set": (_priority_query(MULTI_SET_RULES, ("note", "score", "weight")), _MULTI_SQL),
    "rules_load_generic": (rules_load_generic, _OVERWRITE_SQL),
    "rule_lint_errors": (rule_lint_errors, LINT_ERRORS_SQL),
    "rule_lint_generic": (rule_lint_generic, LINT_GENERIC_SQL),
    **({} if find_spec("yaml") is None else {"rules_yaml_applied": (rules_yaml_applied, _OVERWRITE_SQL)}),
    "rule_lint_warnings": (rule_lint_warnings, LINT_WARNINGS_SQL),
    "rules_load_simple": (rules_load_simple, LOAD_SIMPLE_SQL),
    "rules_load_latest": (rules_load_latest, LOAD_LATEST_SQL),
    "rules_normalized": (
        _normalized("rules"),
        """SELECT 'rule-' || p_partkey AS id, CASE WHEN p_size > 5 THEN p_size ELSE 1000 END AS priority,
         CASE WHEN p_type = 'PROMO' THEN 'any' ELSE 'all' END AS logic, p_size = 50 AS stop_after_match FROM part""",
    ),
    "rules_normalized_predicates": (
        _normalized("predicates"),
        """SELECT 'rule-' || p_partkey AS id, 0 AS idx, 'name' AS column_name, 'contains' AS op, p_name AS value,
         NULL AS values_json FROM part
         UNION ALL SELECT 'rule-' || p_partkey, 1, 'amount', 'between', NULL,
         '["0","' || CAST(p_retailprice AS DECIMAL(10,2)) || '"]' FROM part WHERE p_size > 25""",
    ),
    "rules_normalized_actions": (
        _normalized("actions"),
        """SELECT 'rule-' || p_partkey AS id, 0 AS idx, 'category' AS target, p_type AS set_value FROM part
         UNION ALL SELECT 'rule-' || p_partkey, 1, 'merchant', p_brand FROM part""",
    ),
    "rules_normalized_profiles": (
        _normalized("rule_profiles"),
        "SELECT 'rule-' || p_partkey AS id, unnest(['A', 'R']) AS profile FROM part WHERE p_type = 'SMALL'",
    ),
}
