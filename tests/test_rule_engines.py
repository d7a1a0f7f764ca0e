"""Both rule engines against row-by-row interpreters, on random rows and rules."""

import random
import re

import pytest

from tallybook.operators.first_match import categorize
from tallybook.operators.predicates import predicate
from tallybook.operators.priority import apply_priority_rules

WORDS = ["red", "blue", "rod", "ring", "bolt", "gear", "hot"]
ROW = (
    "key int, name string, note string, amount double, profile_id string, category string, subcategory string, "
    "applied_rules array<string>, operation string, merchant string, is_transfer boolean"
)


def random_rows(rnd, n=400):
    rows = []
    for key in range(n):
        words = [rnd.choice(WORDS) for _ in range(rnd.randint(0, 3))]
        rows.append((
            key,
            rnd.choice([None, " ".join(words)]) if rnd.random() < 0.1 else " ".join(words),
            rnd.choice([None, "x", "Red Rod", "gear"]),
            rnd.choice([None, -5.0, 0.0, 12.5, 100.0]),
            rnd.choice(["p1", "p2", "p3"]),
            rnd.choice([None, None, None, "A", "B"]),
            rnd.choice([None, None, "s9"]),
            rnd.choice([None, None, ["r0"], ["old"]]),
            rnd.choice([None, None, "manual"]),
            None,
            False,
        ))
    return rows


def first_match_row(row, rules):
    row = dict(row)
    for rule in rules:
        text = row[rule.get("column") or "name"]
        if text is None or not re.search(rule["value"], text):
            continue
        trail = row["applied_rules"] or []
        row["applied_rules"] = trail if rule["id"] in trail else [*trail, rule["id"]]
        cat, sub = rule.get("category"), rule.get("subcategory")
        if row["category"] is None:
            if cat is not None:
                row["category"] = cat
            if sub is not None:
                row["subcategory"] = sub
            if row["operation"] is None:
                row["operation"] = f"set_category:{rule['id']}:{cat}" + (f"/{sub}" if sub else "")
        if cat is not None and sub is not None and row["subcategory"] is None and row["category"] == cat:
            row["subcategory"] = sub
    return row


@pytest.mark.parametrize("seed", range(6))
def test_first_match_agrees_with_interpreter(spark, seed):
    rnd = random.Random(seed)
    rules = [
        {
            "id": f"r{rnd.randint(0, 9)}" if rnd.random() < 0.2 else f"r{i}",
            "value": rnd.choice([*WORDS, r"\bred\b.*rod", "(?i)RING|gear", "^hot"]),
            "category": rnd.choice(["A", "B", "C", None] if seed % 2 else ["A", "B", "C"]),
            "subcategory": rnd.choice([None, "s1", "s2"]),
            **({"column": "note"} if rnd.random() < 0.2 else {}),
        }
        for i in range(rnd.randint(1, 9))
    ]
    df = spark.createDataFrame(random_rows(rnd), ROW)
    for keep in (True, False):
        got = {r.key: r.asDict() for r in categorize(df, rules, keep_existing=keep).collect()}
        for row in df.collect():
            start = row.asDict()
            if not keep:
                start.update(category=None, subcategory=None, applied_rules=None, operation=None)
            assert got[row.key] == first_match_row(start, rules)


def test_first_match_without_rules_or_columns(spark):
    out = categorize(spark.range(1).selectExpr("'red' AS name"), [])
    assert out.collect()[0].asDict() == {
        "name": "red", "category": None, "subcategory": None, "applied_rules": None, "operation": None,
    }


def holds(p, row):
    value, op = row[p["column"]], p["op"]
    ci = p.get("case_insensitive", False)

    def low(v):
        return v.lower() if ci and isinstance(v, str) else v

    if op == "equals":
        return low(value) == low(p["value"])
    if value is None:
        return None
    if op == "regex":
        return bool(re.search(p["value"], str(value)))
    if op == "contains":
        return low(p["value"]) in low(value)
    if op == "startswith":
        return low(value).startswith(low(p["value"]))
    if op == "endswith":
        return low(value).endswith(low(p["value"]))
    if op == "in":
        return low(value) in [low(v) for v in p["values"]]
    try:
        number = float(value)
    except ValueError:
        return None
    if op == "between":
        return p["values"][0] <= number <= p["values"][1]
    v = p["value"]
    return {"gt": number > v, "gte": number >= v, "lt": number < v, "lte": number <= v}[op]


def priority_row(row, rules, profile_of):
    row, stopped = dict(row), False

    def matches(rule):
        tests = [holds(p, row) for p in rule.get("match", [])]
        if not tests:
            return True
        return any(t is True for t in tests) if rule.get("logic") == "any" else all(t is True for t in tests)

    for rule in sorted(rules, key=lambda r: (r.get("priority", 1000), r["id"])):
        if rule.get("profiles") and profile_of(row) not in rule["profiles"]:
            continue
        for action in rule["actions"]:
            if not stopped and matches(rule):
                row[action["set"]["target"]] = action["set"]["value"]
        if rule.get("stop_after_match") and not stopped and matches(rule):
            stopped = True
    return row


def random_predicate(rnd):
    op = rnd.choice(["equals", "contains", "regex", "startswith", "endswith", "in", "gt", "gte", "lt", "lte", "between"])
    if op in ("gt", "gte", "lt", "lte"):
        return {"column": rnd.choice(["amount", "note"]), "op": op, "value": rnd.choice([0, 12.5, -5])}
    if op == "between":
        return {"column": "amount", "op": op, "values": [-5, rnd.choice([0, 50])]}
    p = {"column": rnd.choice(["name", "note", "category", "merchant"]), "op": op}
    if op != "regex":
        p["case_insensitive"] = rnd.random() < 0.5
    if op == "in":
        return {**p, "values": rnd.sample(["Red Rod", "GEAR", "A", "red", "m1"], 2)}
    return {**p, "value": rnd.choice(["red", "GEAR", "A", "m1", "ROD", "x"])}


@pytest.mark.parametrize("seed", range(8))
def test_priority_rules_agree_with_interpreter(spark, seed):
    rnd = random.Random(100 + seed)
    targets = {"category": ["A", "B"], "merchant": ["m1", "m2"], "is_transfer": [True, False], "flag": [1, 2]}
    rules = []
    for i in range(rnd.randint(2, 8)):
        sets = []
        for target in rnd.sample(sorted(targets), rnd.randint(1, 3)):
            sets.append({"set": {"target": target, "value": rnd.choice(targets[target])}})
        rules.append({
            "id": f"r{i}",
            "priority": rnd.choice([10, 20, 30]),
            "logic": rnd.choice(["any", "all"]),
            "match": [random_predicate(rnd) for _ in range(rnd.randint(0, 3))],
            "actions": sets,
            "stop_after_match": rnd.random() < 0.3,
            **({"profiles": ["p1", "p2"]} if rnd.random() < 0.3 else {}),
        })
    df = spark.createDataFrame(random_rows(rnd), ROW)
    out = apply_priority_rules(df, rules)
    got = {r.key: r.asDict() for r in out.collect()}
    has_flag = any(a["set"]["target"] == "flag" for r in rules for a in r["actions"])
    for row in df.collect():
        start = {**row.asDict(), **({"flag": None} if has_flag else {})}
        assert got[row.key] == priority_row(start, rules, lambda r: r["profile_id"])

    one = apply_priority_rules(df.filter("profile_id = 'p3'"), rules, profile="p3")
    for row in one.collect():
        assert row.asDict() == got[row.key]


def test_unscoped_run_ignores_profiles(spark):
    rules = [{"id": "a", "profiles": ["p9"], "actions": [{"set": {"target": "t", "value": "x"}}]}]
    df = spark.sql("SELECT 'p1' AS profile_id")
    assert apply_priority_rules(df, rules, profile_column=None).collect()[0].t == "x"
    assert apply_priority_rules(df, rules).collect()[0].t is None


def test_unknown_operator_fails_before_any_job():
    with pytest.raises(ValueError, match="unknown rule operator"):
        predicate({"column": "name", "op": "sounds_like", "value": "x"})


def test_first_match_plan_runs_each_pattern_once(spark):
    df = spark.sql("SELECT id, concat('red rod ', id) AS name FROM range(10)")
    rules = [{"id": f"r{i}", "value": f"rod.*{i}", "category": "A", "subcategory": f"s{i}"} for i in range(20)]
    plan = categorize(df, rules)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == 20
