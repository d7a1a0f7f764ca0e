"""Amounts are read without loss, written with all digits, and what can't be read is kept beside the rows."""

import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallybook.functions.money import money_text, not_read, to_money
from tallybook.operators.canonicalize import unread_values
from tallybook.operators.predicates import predicate
from tallybook.operators.rule_checks import java_faults, lint_errors, lint_generic_errors
from tallybook.plans.jobs import build_silver
from tallybook.sources.inbox import list_files
from tallybook.sources.lake import Lake, read_bronze, read_silver
from tallybook.sources.rules import load_generic_rules, load_simple_rules
from tallybook.streaming.inbox_stream import ingest_files


@pytest.mark.parametrize("text,amount,shown,reason", [
    ("123456789012345.12345678", "123456789012345.12345678", "123456789012345.12345678", None),
    ("-640", "-640", "-640.0", None),
    ("0.00000123", "0.00000123", "0.00000123", None),
    ("10000000", "10000000", "10000000.0", None),
    ("5.10000000000", "5.1", "5.1", None),
    ("1e5", "100000", "100000.0", None),
    ("1e-9", "0", "0.0", "rounded"),
    ("0.123456789", "0.12345679", "0.12345679", "rounded"),
    ("1,234.50", None, None, "no number"),
    ("n/a", None, None, "no number"),
    ("99999999999999999999999999", None, None, "too large"),
    ("1e30", None, None, "too large"),
    (" ", None, None, None),
    (None, None, None, None),
])
def test_amount_texts(spark, text, amount, shown, reason):
    df = spark.createDataFrame([(text,)], "t string")
    money = to_money(F.col("t"))
    row = df.select(money.alias("m"), money_text(money).alias("s"), not_read("amount", F.col("t"))["reason"].alias("r")).first()
    assert (row.m, row.s, row.r) == (None if amount is None else Decimal(amount), shown, reason)


def test_values_that_are_no_amount_stay_in_bronze(spark, tmp_path):
    lake = Lake(f"{tmp_path}/lake")
    for name, text in (
        ("new [1].csv", "Date,Details,Debit,Credit,Balance\n2024-01-02,Fee,n/a,,7\n2024-01-03,Pay,,123456789012345.00000001,--\n"),
        ("late.csv", "Date,Details,Amount\n2024-01-04,Rent,\"1,200\"\n2024-01-05,Tea,-2.5\n"),
    ):
        os.makedirs(f"{tmp_path}/in/ann", exist_ok=True)
        (tmp_path / "in/ann" / name).write_text(text)
    files = list_files(spark, f"{tmp_path}/in/ann").collect()
    assert ingest_files(spark, [*files, *files], lake, "q-0") == 2  # every file named twice
    assert read_bronze(spark, lake).count() == 4
    got = {(r.source_file, r.description, r.role, r.text, r.reason) for r in unread_values(read_bronze(spark, lake)).collect()}
    assert got == {
        ("new [1].csv", "Fee", "debit", "n/a", "no number"), ("new [1].csv", "Pay", "balance", "--", "no number"),
        ("late.csv", "Rent", "amount", "1,200", "no number"),
    }
    plan = unread_values(read_bronze(spark, lake))._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(unread)" in plan
    build_silver(spark, lake)
    assert Decimal("123456789012345.00000001") in {r.amount for r in read_silver(spark, lake).collect()}


@pytest.mark.parametrize("spec,ids", [
    ({"column": "money", "op": "equals", "value": "5"}, {1}),
    ({"column": "money", "op": "equals", "value": " 5.000 "}, {1}),
    ({"column": "size", "op": "equals", "value": "2.5e0"}, {2}),
    ({"column": "n", "op": "equals", "value": "01"}, {1}),
    ({"column": "text", "op": "equals", "value": "5"}, {1}),
    ({"column": "text", "op": "equals", "value": "05"}, set()),
    ({"column": "n", "op": "equals", "value": "one"}, set()),
    ({"column": "n", "op": "equals", "value": "NaN"}, set()),
    ({"column": "n", "op": "in", "values": ["1.0", "x", None]}, {1}),
    ({"column": "money", "op": "in", "values": ["7", 5]}, {1, 2}),
    ({"column": "text", "op": "in", "values": ["5", "7.0"]}, {1}),
])
def test_texts_that_are_numbers(spark, spec, ids):
    rows = spark.sql("SELECT * FROM VALUES (1, 1, '5', CAST(5 AS DECIMAL(30,8)), 1.0D), (2, 2, '7', CAST(7 AS DECIMAL(30,8)), 2.5D), (3, NULL, NULL, NULL, NULL) AS t(id, n, text, money, size)")
    assert {r.id for r in rows.filter(predicate(spec)).collect()} == ids


def test_patterns_are_compiled_in_java_too(spark, tmp_path):
    assert java_faults(spark, [r"a(?<x>b)\b", "(?P<x>a)", "a{2"]) == {"(?P<x>a)": "Unknown inline modifier", "a{2": "Unclosed counted closure"}
    good = {"id": "a", "description": "d", "op": "regex", "value": "a+", "category": "C", "subcategory": "S"}
    lines = [good, {**good, "id": "b", "value": "(?P<x>a)"}]
    (tmp_path / "r.ndjson").write_text("\n".join(map(json.dumps, lines)))
    text = spark.createDataFrame([("r", i, json.dumps(line)) for i, line in enumerate(lines)], "file string, line int, text string")
    assert [(r.line, r.kind, r.detail) for r in lint_errors(text).collect()] == [(1, "regex_not_for_java", "Unknown inline modifier")]
    with pytest.raises(ValueError, match="r.ndjson:2 .*Unknown inline modifier"):
        load_simple_rules(spark, str(tmp_path))
    generic = {"id": "g", "priority": 1, "logic": "all", "actions": [], "match": [{"column": "name", "op": "regex", "value": "(?P<x>a)"}]}
    (tmp_path / "g.txt").write_text(json.dumps(generic))
    with pytest.raises(ValueError, match="g.txt:1 .*Unknown inline modifier"):
        load_generic_rules(spark, str(tmp_path), "*.txt")
    assert lint_generic_errors(spark.createDataFrame([("g", 1, json.dumps({**generic, "match": []}))], "file string, line int, text string")).isEmpty()
