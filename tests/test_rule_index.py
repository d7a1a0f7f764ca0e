"""Large rule sets by the inverted index, against the engine that tests every pattern."""

import random
import re

import pytest

from tallybook.operators.first_match import categorize
from tallybook.operators.rule_index import categorize_indexed, index_rows, needed_literals
from tests.test_rule_engines import ROW, random_rows

LABELS = ("key", "category", "subcategory", "applied_rules", "operation")


@pytest.mark.parametrize("pattern,need", [
    (r"(?i)\bHot\s+(ring|plate)\b", ["plate", "ring"]),
    (r"hot (ring|plate)s?", ["hot "]),
    (r"^rods? iron$", [" iron"]),
    (r"a|bolt", None),
    (r"bolt|gear", ["bolt", "gear"]),
    (r"(?:old|new)+ gear{2}s", [" gear"]),
    (r"gea?rs*x", None),
    (r"[bolt]+ed\.com/x", ["ed.com/x"]),
    (r"(?=never)gears", ["gears"]),
    (r"(?!gears|bolts)ring", ["ring"]),
    (r"(?<name>bolt)(gear)?", ["bolt"]),
    (r"(bolt|(gear|ring)s)", ["bolt", "gear", "ring"]),
    (r"(bolt|x*)", None),
    (r"(bolt){0,2}", None),
    (r"(bolt){2}", ["bolt"]),
    (r"[]ab]café", ["caf"]),
    (r"\Qa.b\Egear", None),
    (r"(?x) gear # parts", None),
    (r"\x67ear", None),
    (r"", None),
    (r"^\d+$", None),
])
def test_needed_literals(pattern, need):
    assert needed_literals(pattern) == need


def random_pattern(rnd):
    def atom(depth):
        kind = rnd.random()
        if kind < 0.55 or depth > 1:
            return re.escape(rnd.choice(["red", "blue", "rod", "ring", "bolt", "gear", "hot", "r", " "]))
        if kind < 0.75:
            return f"({'|'.join(sequence(depth + 1) for _ in range(rnd.randint(1, 3)))})"
        return rnd.choice([".", "[a-z]", r"\b", r"\s", "(?:ho)", "(?=g)", "^", "$", "[^x]"])

    def sequence(depth=0):
        return "".join(atom(depth) + rnd.choice(["", "", "", "", "?", "+", "*", "{1,2}", "{0}"]) for _ in range(rnd.randint(1, 3)))

    while True:
        pattern = rnd.choice(["", "", "(?i)"]) + sequence()
        try:
            re.compile(pattern)
        except re.error:
            continue
        if not re.search(r"(\\b|\^|\$)[?+*{]", pattern):  # Java refuses some of these
            return pattern


def test_every_match_holds_a_needed_literal():
    rnd = random.Random(4)
    words = ["red", "blue", "rod", "Ring", "bolt", "gear", "HOT", "r", "x"]
    found = 0
    for _ in range(4000):
        pattern = random_pattern(rnd)
        need = needed_literals(pattern)
        for _ in range(12):
            text = " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 5)))
            if need is not None and re.search(pattern, text):
                found += 1
                assert any(x in text.lower() for x in need), (pattern, text, need)
    assert found > 1000


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("keep", [True, False])
def test_as_the_engine_that_tests_every_pattern(spark, seed, keep):
    rnd = random.Random(seed)
    rules = [
        {"id": rnd.choice([f"r{i}", "r0", None]), "value": random_pattern(rnd), "category": rnd.choice([None, "A", "B", "C"]),
         "subcategory": rnd.choice([None, "s1", "s2"]), "column": rnd.choice([None, None, "name", "note", "amount"])}
        for i in range(rnd.choice([1, 12, 40]))
    ]
    df = spark.createDataFrame(random_rows(rnd, 300), ROW)
    want = {tuple(map(str, r)) for r in categorize(df, rules, keep).select(*LABELS).collect()}
    indexed = categorize_indexed(df, rules, keep)
    assert indexed.columns == categorize(df, rules, keep).columns
    assert {tuple(map(str, r)) for r in indexed.select(*LABELS).collect()} == want and len(want) == 300


def test_no_rules_and_no_rows(spark):
    df = spark.createDataFrame(random_rows(random.Random(0), 5), ROW)
    assert categorize_indexed(df, []).count() == 5
    assert categorize_indexed(df.limit(0), [{"value": "gear", "category": "A"}]).count() == 0


def test_index_takes_the_rarest_piece():
    rows, broad = index_rows({0: "Brand#12 rod", 1: "Brand#12 ring", 2: r"\d+"})
    assert [(piece, rule) for piece, _, _, rule in rows] == [(" ro", 0), (" ri", 1)] and broad == {2: r"\d+"}


def test_patterns_are_joined_not_crossed(spark):
    rules = [{"id": str(i), "value": f"shop {i:04d}$", "category": "A"} for i in range(3000)]
    df = spark.createDataFrame([(f"the shop {i:04d}",) for i in range(0, 6000, 7)], "name string")
    out = categorize_indexed(df, rules)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert out.where("category = 'A'").count() == len(range(0, 3000, 7))
