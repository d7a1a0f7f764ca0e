"""Rule files: loading, defaults, rejections, lint, tables."""

import json

import pytest

from tallybook.operators.rule_checks import lint_errors, lint_generic_errors, lint_warnings
from tallybook.operators.rule_tables import write_rule_tables
from tallybook.sources.rules import load_generic_rules, load_rules_yaml, load_simple_rules, rule_lines, rules_table

FULL = {"id": "a", "description": "d", "op": "regex", "value": "x", "category": "C", "subcategory": "S"}


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines))


def test_simple_rules_in_file_and_line_order(spark, tmp_path):
    put(tmp_path, "b.ndjson", {"value": "b", "category": "B"})
    put(tmp_path, "a.ndjson", "# comment", "", {"value": "a\\d", "column": "note", "category": "A"}, FULL)
    put(tmp_path, "c.txt", "not a rule")
    rules = load_simple_rules(spark, str(tmp_path))
    assert [(r["id"], r["column"], r["value"]) for r in rules] == [("a:3", "note", "a\\d"), ("a", "name", "x"), ("b:1", "name", "b")]


@pytest.mark.parametrize("line, message", [
    ("{broken", "invalid JSON"), ({"value": "(", "category": "C"}, "regex does not compile"),
    ({"value": "x", "op": "contains"}, "only op 'regex'"), ("[1]", "invalid JSON"), ('{"id": "x"} tail', "invalid JSON"),
])
def test_simple_rules_reject(spark, tmp_path, line, message):
    put(tmp_path, "a.ndjson", FULL, line)
    with pytest.raises(ValueError, match=f"a.ndjson:2 .*{message}"):
        load_simple_rules(spark, str(tmp_path))


def generic(rule_id, **kw):
    return {"id": rule_id, "priority": 5, "logic": "ANY", "actions": [{"set": {"target": "t", "value": True}}], **kw}


def test_generic_rules_last_one_wins_in_priority_order(spark, tmp_path):
    put(tmp_path, "a.ndjson", generic("z"), generic("a", priority=9), generic("m", note="first"))
    put(tmp_path, "b.ndjson", generic("m", note="second", priority=1))
    rules = load_generic_rules(spark, str(tmp_path))
    assert [(r["id"], r["logic"], r.get("note")) for r in rules] == [("m", "any", "second"), ("z", "any", None), ("a", "any", None)]
    assert rules[0]["actions"][0]["set"]["value"] is True


@pytest.mark.parametrize("rule, message", [
    ({"id": "x", "priority": 1, "logic": "all"}, "missing field: actions"), (generic("x", logic="some"), "logic must be"),
    (generic("x", match=[{"column": "n", "op": "regex", "value": "["}]), "regex does not compile"),
])
def test_generic_rules_reject(spark, tmp_path, rule, message):
    put(tmp_path, "a.ndjson", rule)
    with pytest.raises(ValueError, match=message):
        load_generic_rules(spark, str(tmp_path))
    faults = lint_generic_errors(rule_lines(spark, str(tmp_path))).collect()
    assert any(message in f.detail for f in faults)


def test_lint(spark, tmp_path):
    put(tmp_path, "a.ndjson", FULL, {**FULL, "value": "y"}, {"id": "n", "op": "REGEX", "value": "x"}, "{")
    put(tmp_path, "b.ndjson", {**FULL, "id": "b", "category": None, "op": "equals"}, {**FULL, "id": "c", "value": "*"})
    lines = rule_lines(spark, str(tmp_path))
    errors = {(r.file, r.line, r.kind, r.detail if r.kind == "missing_field" else None) for r in lint_errors(lines).collect()}
    assert errors == {
        ("a.ndjson", 3, "missing_field", "description"), ("a.ndjson", 3, "missing_field", "category"),
        ("a.ndjson", 3, "missing_field", "subcategory"), ("a.ndjson", 4, "invalid_json", None),
        ("b.ndjson", 1, "unsupported_op", None), ("b.ndjson", 2, "regex_does_not_compile", None),
    }
    warnings = {(r.file, r.line, r.kind, r.first_file, r.first_line) for r in lint_warnings(lines).collect()}
    assert warnings == {
        ("a.ndjson", 2, "duplicate_id", "a.ndjson", 1), ("a.ndjson", 3, "duplicate_pattern", "a.ndjson", 1),
        ("b.ndjson", 1, "duplicate_pattern", "a.ndjson", 1),
    }


def test_yaml_rules_and_rule_tables(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "rules.yaml").write_text("""
rules:
  - id: pay
    priority: 40
    logic: all
    match:
      - {column: amount, op: gt, value: 0}
      - {column: name, op: in, values: [a, "d[-\\\\s]?b"], case_insensitive: true}
    actions:
      - {set: {target: category, value: Income}}
      - {set: {target: is_transfer, value: true}}
    profiles: [p, q]
  - {id: rest, actions: []}
""")
    rules = load_rules_yaml(str(tmp_path / "rules.yaml"))
    write_rule_tables(rules_table(spark, rules), str(tmp_path / "bundle"))

    def rows(name):
        return sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "bundle" / name)).collect())

    assert rows("rules") == [("pay", 40, "all", False), ("rest", 1000, "all", False)]
    assert rows("predicates") == [("pay", 0, "amount", "gt", "0", None), ("pay", 1, "name", "in", None, '["a","d[-\\\\s]?b"]')]
    assert rows("actions") == [("pay", 0, "category", "Income"), ("pay", 1, "is_transfer", "true")]
    assert rows("rule_profiles") == [("pay", "p"), ("pay", "q")]
