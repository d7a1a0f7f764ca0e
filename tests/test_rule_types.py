"""Rules whose literals are of another type than their column."""

import pytest

from tallybook.operators.predicates import predicate
from tallybook.operators.priority import apply_priority_rules
from tallybook.sources.rules import rule_lines


@pytest.fixture(scope="module")
def rows(spark):
    return spark.sql("SELECT * FROM VALUES (1, '12', CAST(12 AS DECIMAL(18,4)), true), (2, 'Twelve', 5.5, false), (3, NULL, NULL, NULL) AS t(id, text, money, flag)")


@pytest.mark.parametrize("spec,ids", [
    ({"column": "text", "op": "equals", "value": 12}, {1}),
    ({"column": "text", "op": "equals", "value": "twelve", "case_insensitive": True}, {2}),
    ({"column": "money", "op": "equals", "value": "shop"}, set()),
    ({"column": "money", "op": "equals", "value": 5.5}, {2}),
    ({"column": "money", "op": "equals", "value": None}, {3}),
    ({"column": "flag", "op": "equals", "value": False}, {2}),
    ({"column": "text", "op": "in", "values": [12, "Twelve", None]}, {1, 2}),
    ({"column": "money", "op": "in", "values": ["shop", 12]}, {1}),
    ({"column": "text", "op": "in", "values": []}, set()),
])
def test_unlike_types_compare(rows, spec, ids):
    assert {r.id for r in rows.filter(predicate(spec)).collect()} == ids


def _rule(target, value):
    return {"id": "odd", "priority": 1, "match": [], "actions": [{"set": {"target": target, "value": value}}]}


@pytest.mark.parametrize("target,value", [("money", "shop"), ("id", 2.5), ("id", 1 << 40), ("flag", "maybe"), ("money", True)])
def test_a_set_that_does_not_fit_is_refused(rows, target, value):
    with pytest.raises(ValueError, match="rule odd"):
        apply_priority_rules(rows, [_rule(target, value)])


def test_a_set_that_fits_is_written(rows):
    assert {str(r.money) for r in apply_priority_rules(rows, [_rule("money", "7.25")]).collect()} == {"7.2500"}


def test_file_names_are_decoded(spark, tmp_path):
    (tmp_path / "r one+50%.ndjson").write_text("{}")
    assert rule_lines(spark, str(tmp_path)).first().file == "r one+50%.ndjson"
