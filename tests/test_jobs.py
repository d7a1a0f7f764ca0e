"""Inbox to exports on small files, in several header layouts."""

import csv
import glob
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from tallybook.operators.canonicalize import canonicalize
from tallybook.plans.jobs import build_exports, build_gold, build_silver, run_all
from tallybook.sources.inbox import file_contents, list_files
from tallybook.sources.lake import Lake, read_bronze, read_categorized, read_fact, read_monthly, read_silver, read_table
from tallybook.schemas import REGISTRY
from tallybook.streaming.inbox_stream import ingest_files, ingest_inbox

STATEMENT = """Txn_Date,Narration,Dr,Cr,Closing Balance,Curr,Acct No
2023-03-07,Harbour  Bakery,14.20,,885.80,EUR,K-77
2023-03-19,Tram refund,,6.50,892.30,EUR,K-77
2023-04-02,Cinema Lux,-21.75,,870.55,EUR,K-77
2023-04-28,Lease for May,640,,230.55,EUR,K-77
"""
RULE = {"id": "bread", "description": "bakeries", "op": "regex", "value": "(?i)baker(y|ies)", "category": "Food",
        "subcategory": "Bread"}


def put(path, text, mode="w"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode) as f:
        f.write(text)


def key(profile, account, day, amount, desc):
    text = f"{profile}|{account}|{day}|{amount:.2f}|{desc.strip().lower()}"
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def drain(spark, root, **kw):
    query = ingest_inbox(spark, f"{root}/inbox", Lake(f"{root}/lake"), f"{root}/checkpoint", **kw)
    query.awaitTermination()


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def test_whole_run(spark, root):
    put(f"{root}/inbox/ann/sample.csv", STATEMENT)
    put(f"{root}/rules/shops.ndjson", "# shops\n\n" + json.dumps(RULE) + "\n")
    lake = Lake(f"{root}/lake")
    run_all(spark, f"{root}/inbox", lake, f"{root}/rules", f"{root}/out", f"{root}/checkpoint")

    rows = {}
    for path in glob.glob(f"{root}/out/transactions/profile=ann/*.csv"):
        with open(path) as f:
            rows.update({r["txn_id"]: r for r in csv.DictReader(f)})
    assert len(rows) == 4
    bread = rows[key("ann", "K-77", "2023-03-07", -14.2, "harbour bakery")]
    refund = rows[key("ann", "K-77", "2023-03-19", 6.5, "tram refund")]
    cinema = rows[key("ann", "K-77", "2023-04-02", -21.75, "cinema lux")]
    lease = rows[key("ann", "K-77", "2023-04-28", -640.0, "lease for may")]
    assert (bread["amount"], bread["clean_desc"], bread["operation"]) == ("-14.2", "harbour bakery", "set_category:bread:Food/Bread")
    assert (refund["amount"], refund["operation"], refund["is_transfer"]) == ("6.5", "", "false")
    assert (cinema["amount"], cinema["category"], lease["amount"]) == ("-21.75", "", "-640.0")
    assert list(bread)[:4] == ["profile_id", "txn_id", "account_id", "post_date"]

    monthly = spark.read.option("header", True).csv(f"{root}/out/category_monthly")
    got = {(r.year, r.month, r.category, r.subcategory, r.total_amount) for r in monthly.collect()}
    assert got == {
        ("2023", "3", None, None, "6.5"),
        ("2023", "3", "Food", "Bread", "-14.2"),
        ("2023", "4", None, None, "-661.75"),
    }
    spend = spark.read.option("header", True).csv(f"{root}/out/category_spend_only")
    assert {(r.category, r.spend) for r in spend.collect()} == {("Food", "14.2"), (None, "661.75")}
    assert {r.profile for r in spend.collect()} == {"ann"}


def test_each_content_enters_once(spark, root):
    lake = Lake(f"{root}/lake")
    put(f"{root}/inbox/ann/b.csv", STATEMENT)
    put(f"{root}/inbox/ann/a.csv", STATEMENT)  # same content, same batch
    put(f"{root}/inbox/bob/a.csv", STATEMENT)  # same content, other profile
    put(f"{root}/inbox/bob/notes.txt", "not a statement")
    drain(spark, root)
    assert read_bronze(spark, lake).count() == 8
    registry = read_table(spark, lake.registry, REGISTRY)
    assert {(r.profile_id, r.file) for r in registry.collect()} == {(p, "a.csv") for p in ("ann", "bob")}
    assert len({r.sha256 for r in registry.collect()}) == 1  # one content, whoever owns it

    put(f"{root}/inbox/ann/later.csv", STATEMENT)  # known content
    put(f"{root}/inbox/ann/new [1] +50%.csv", STATEMENT.replace("640", "641"))
    put(f"{root}/inbox/ann/empty.csv", "")  # no bytes: the source passes it over
    drain(spark, root)
    assert read_bronze(spark, lake).count() == 12
    assert read_table(spark, lake.registry, REGISTRY).count() == 3
    names = {r.source_file for r in read_bronze(spark, lake).select("source_file").distinct().collect()}
    assert names == {"a.csv", "new [1] +50%.csv"}

    drain(spark, root)  # nothing new
    assert read_bronze(spark, lake).count() == 12

    build_silver(spark, lake)
    assert read_silver(spark, lake).count() == 4 + 1 + 4  # two rows of the later file are known transactions


def test_lost_checkpoint_keeps_old_batches(spark, root):
    lake = Lake(f"{root}/lake")
    put(f"{root}/inbox/ann/a.csv", STATEMENT)
    drain(spark, root)
    put(f"{root}/inbox/ann/b.csv", STATEMENT.replace("640", "99"))
    ingest_inbox(spark, f"{root}/inbox", lake, f"{root}/second").awaitTermination()
    assert read_bronze(spark, lake).count() == 8


def test_batch_run_again_after_failure_changes_nothing(spark, root):
    lake = Lake(f"{root}/lake")
    put(f"{root}/inbox/ann/a.csv", STATEMENT)
    put(f"{root}/inbox/bob/b.csv", STATEMENT)
    files = list_files(spark, f"{root}/inbox/ann", f"{root}/inbox/bob").collect()
    for _ in range(2):
        assert ingest_files(spark, files, lake, "q-000000001") == 2
    assert read_bronze(spark, lake).count() == 8
    assert ingest_files(spark, files, lake, "q-000000002") == 0
    assert read_bronze(spark, lake).count() == 8


def test_archive(spark, root):
    put(f"{root}/inbox/ann/a.csv", STATEMENT)
    drain(spark, root, archive=f"{root}/archive")
    put(f"{root}/inbox/ann/b.csv", STATEMENT.replace("640", "1"))
    drain(spark, root, archive=f"{root}/archive")
    moved = glob.glob(f"{root}/archive/**/*.csv", recursive=True)
    assert [os.path.basename(p) for p in moved] == ["a.csv"]
    assert read_bronze(spark, Lake(f"{root}/lake")).count() == 8


def test_layouts(spark, root):
    put(f"{root}/inbox/p/1.csv", "Txn_Date,NARRATION,Withdrawal Amt.,Deposit Amt.,Closing Balance\n"
                                 "31/12/2024,Rent,\"900\",,10\n01/02/2025,Pay,,1000.125,1010.125\n")
    put(f"{root}/inbox/p/2.csv", "﻿Posting Date,Remarks,Transaction Amount,Account No,Curr\n"
                                 "5 Jan 2025,\"Shop, corner\",-12.5,0042,USD\n\n6 Jan 2025,Odd,\"1,234.50\",0042,USD\n")
    put(f"{root}/inbox/p/3.csv", "Date,Details\n2025-02-03,No amount\n")
    put(f"{root}/inbox/p/4.csv", "Date,date,Details,Amount\n2025-02-03,2025-02-04,Twice,1\n")
    drain(spark, root)
    lake = Lake(f"{root}/lake")
    build_silver(spark, lake)
    got = {
        (r.description, str(r.post_date), r.amount, r.balance, r.currency, r.account_id)
        for r in read_silver(spark, lake).withColumn("amount", F.col("amount").cast("double"))
        .withColumn("balance", F.col("balance").cast("double")).collect()
    }
    assert got == {
        ("Rent", "2024-12-31", -900.0, 10.0, None, None),
        ("Pay", "2025-01-02", 1000.125, 1010.125, None, None),
        ("Shop, corner", "2025-01-05", -12.5, None, "USD", "0042"),
        ("Odd", "2025-01-06", None, None, "USD", "0042"),
        ("No amount", "2025-02-03", 0.0, None, None, None),
        ("Twice", "None", 1.0, None, None, None),
    }


def test_alias_order_wins_over_column_order(spark):
    df = spark.sql("SELECT '2' AS Value, '1' AS AMOUNT, 'x' AS `Value Date`, 'y' AS `date`, 'd' AS debit")
    row = canonicalize(df).collect()[0]
    assert (row.amount, row.post_date) == (1, "y")


def test_header_owner_and_order_of_lines(spark, root):
    head, *rows = STATEMENT.splitlines()
    put(f"{root}/inbox/p/a.csv", STATEMENT)
    put(f"{root}/inbox/p/b.csv", "\n".join([head, *reversed(rows)]) + "\n")  # same lines, another order
    put(f"{root}/inbox/p/c.csv", "\n" * 70_000 + STATEMENT.replace("640", "641"))
    put(f"{root}/inbox/p/d.csv", " " + STATEMENT.replace("640", "642"))  # another header: no date column
    put(f"{root}/inbox/p/blank.csv", "\n \n")
    put(f"{root}/inbox/p/2023/e.csv", STATEMENT.replace("640", "643"))
    put(f"{root}/inbox/f.csv", STATEMENT.replace("640", "644"))
    drain(spark, root)
    lake = Lake(f"{root}/lake")
    got = {r.source_file: (r.rows, r.dated) for r in read_bronze(spark, lake).groupBy("source_file").agg(
        F.count("*").alias("rows"), F.count("post_date").alias("dated")).collect()}
    assert {k: v for k, v in got.items() if k != "d.csv"} == {"a.csv": (4, 4), "c.csv": (4, 4)} and got["d.csv"][0] == 4
    assert {r.profile_id for r in read_bronze(spark, lake).select("profile_id").collect()} == {"p"}
    assert {r.file for r in read_table(spark, lake.registry, REGISTRY).collect()} == {"a.csv", "c.csv", "d.csv"}


def test_files_are_fingerprinted_by_lines(spark, root):
    for name, text in (("a", STATEMENT), ("b", STATEMENT), ("c", STATEMENT.replace("640", "641"))):
        put(f"{root}/inbox/p/{name}.csv", text)
    files = list_files(spark, f"{root}/inbox/p").collect()
    by_name = {r.file: r.sha256 for r in file_contents(spark, files).collect()}
    assert by_name["a.csv"] == by_name["b.csv"] != by_name["c.csv"]
    lake = Lake(f"{root}/lake")
    assert ingest_files(spark, files, lake, "q-0") == 2
    assert read_bronze(spark, lake).count() == 8


def test_profile_names_stay_text(spark, root):
    put(f"{root}/inbox/007/a.csv", STATEMENT)
    put(f"{root}/rules/r.ndjson", json.dumps(RULE))
    lake = Lake(f"{root}/lake")
    run_all(spark, f"{root}/inbox", lake, f"{root}/rules", f"{root}/out", f"{root}/checkpoint")
    for table in (read_bronze, read_silver, read_categorized, read_fact, read_monthly):
        assert {r.profile_id for r in table(spark, lake).select("profile_id").distinct().collect()} == {"007"}


def test_gold_can_be_rebuilt(spark, root):
    put(f"{root}/inbox/ann/a.csv", STATEMENT)
    put(f"{root}/rules/r.ndjson", json.dumps(RULE))
    lake = Lake(f"{root}/lake")
    run_all(spark, f"{root}/inbox", lake, f"{root}/rules", f"{root}/out", f"{root}/checkpoint")
    build_gold(spark, lake)
    build_exports(spark, lake, f"{root}/out")
    assert read_monthly(spark, lake).count() == 3
    assert spark.read.option("header", True).csv(f"{root}/out/transactions").count() == 4
