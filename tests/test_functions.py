"""Column functions: dates, keys, money, labels."""

import hashlib
import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallybook.functions.dates import with_parsed_date
from tallybook.functions.money import outflow, signed_amount, to_money
from tallybook.functions.text import category_label, clean_desc, first_filled, or_dash, txn_id

SPELLINGS = {
    "2024-01-05": date(2024, 1, 5),
    "2024-1-5": date(2024, 1, 5),
    "2024-01-05 10:00:00": date(2024, 1, 5),
    "2024-01-05T23:30:00-05:00": date(2024, 1, 5),  # the day as written
    "2024-13-01": date(2024, 1, 13),
    "2024/01/05": date(2024, 1, 5),
    "20240105": date(2024, 1, 5),
    "240105": date(2024, 1, 5),
    "01/02/2024": date(2024, 1, 2),
    "31/12/2024": date(2024, 12, 31),
    "01/02/03": date(2001, 2, 3),
    "13/02/24": date(2013, 2, 24),
    "05-01-2025": date(2025, 5, 1),
    "25/12/99": date(1999, 12, 25),
    "5 Jan 2024": date(2024, 1, 5),
    "Mon, January 5th, 2024": date(2024, 1, 5),
    "31-Jan-2024": date(2024, 1, 31),
    "2024-02-30": None,
    "5 Jan": None,  # the year would be today's
    "2024-01": None,
    "2024": None,
    "240105123": None,
    "balance": None,
    "": None,
}


def test_date_spellings(spark):
    df = spark.createDataFrame([*[(s,) for s in SPELLINGS], (None,)], "s string")
    got = {r.s: r.d for r in with_parsed_date(df, "s", "d").collect()}
    assert got == {**SPELLINGS, None: None}


def test_dates_agree_with_dateutil(spark):
    parser = pytest.importorskip("dateutil.parser")

    def expected(text):
        for order in ({"dayfirst": False, "yearfirst": True}, {"dayfirst": True}):
            try:
                return parser.parse(text, **order).date()
            except (ValueError, OverflowError):
                continue
        return None

    rnd = random.Random(3)
    months = "Jan feb MAR April may Jun July Aug Sept Oct November Dec".split()
    texts = set()
    for _ in range(3000):
        width = rnd.choice(["{}", "{:02d}"])
        year = rnd.choice([rnd.randint(1950, 2060), rnd.randint(0, 60)])
        parts = [width.format(rnd.randint(0, 33)), width.format(rnd.randint(0, 33)), width.format(year)]
        if rnd.random() < 0.4:
            parts[0] = rnd.choice(months)
            sep = rnd.choice(" -")
        else:
            sep = rnd.choice("-/. ")
        rnd.shuffle(parts)
        texts.add(sep.join(parts) + rnd.choice(["", "", " 10:15", " 9:05 PM"]))
    df = spark.createDataFrame([(t,) for t in sorted(texts)], "s string")
    wrong = [(r.s, r.d) for r in with_parsed_date(df, "s", "d").collect() if r.d != expected(r.s)]
    assert wrong == []


def test_century_pivot(spark):
    df = spark.sql("SELECT '01/31/80' AS s")
    assert with_parsed_date(df, "s", "d").collect()[0].d == date(1980, 1, 31)
    assert with_parsed_date(df, "s", "d", century_pivot=90).collect()[0].d == date(2080, 1, 31)


def test_txn_id_is_the_head_of_a_sha256(spark):
    rows = [
        ("zoe", "77-31", date(2021, 6, 30), Decimal("18.4"), "  Bus Ticket   zone B "),
        ("zoe", "", date(2019, 2, 28), Decimal("-4000"), "RENT"),
        (None, None, None, None, None),
        ("", "77-31", date(2020, 2, 29), Decimal("-0.07"), " \tTab and nbsp "),
    ]
    df = spark.createDataFrame(rows, "p string, a string, d date, m decimal(18,4), t string")
    got = df.select(txn_id(*[F.col(c) for c in "padmt"]).alias("k")).collect()
    for row, k in zip(rows, got):
        p, a, d, m, t = row
        text = f"{p or ''}|{a or ''}|{d or ''}|{m or 0:.2f}|{(t or '').strip().lower()}"
        assert k.k == hashlib.sha256(text.encode()).hexdigest()[:16]


def test_clean_desc_keeps_the_ends(spark):
    df = spark.createDataFrame([("  Big \t\n SHOP ",)], "t string")
    assert df.select(clean_desc(F.col("t")).alias("c")).collect()[0].c == " big shop "


def test_money(spark):
    df = spark.createDataFrame(
        [("5", None), (None, "-7.25"), ("x", "2"), (None, None), ("-3", "-4")], "c string, d string"
    )
    got = [r.a for r in df.select(signed_amount(F.col("c"), F.col("d")).alias("a")).collect()]
    assert got == [Decimal(5), Decimal("-7.25"), Decimal(-2), Decimal(0), Decimal(-1)]
    texts = spark.createDataFrame([("1,234.50",), ("1e3",), ("",), ("12.345",)], "t string")
    assert [r.m for r in texts.select(to_money(F.col("t")).alias("m")).collect()] == [
        None, Decimal(1000), None, Decimal("12.345"),
    ]
    amounts = spark.createDataFrame([(Decimal("-2.5"),), (Decimal(3),), (None,)], "a decimal(18,4)")
    assert [r.o for r in amounts.select(outflow(F.col("a")).alias("o")).collect()] == [Decimal("2.5"), 0, 0]


def test_labels(spark):
    df = spark.createDataFrame([("", "b", None), (None, None, "")], "x string, y string, z string")
    rows = df.select(
        first_filled(F.col("x"), F.col("y")).alias("f"), or_dash(F.col("x")).alias("d"), category_label(F.col("z")).alias("c")
    ).collect()
    assert [tuple(r) for r in rows] == [("b", "—", "Uncategorized"), (None, "—", "")]
