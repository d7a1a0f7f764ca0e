"""Lake tables that are brought up to date batch by batch, and the index of loaded contents."""

import glob
import os
import shutil
from datetime import date

import pytest
from pyspark.sql import functions as F

from tallybook.operators import ranges
from tallybook.plans import incremental
from tallybook.plans.jobs import build_categorized, build_gold, build_silver
from tallybook.schemas import SILVER
from tallybook.sources.contents import commit_batch, known_contents, read_state
from tallybook.sources.folders import folder_name, read_folder_statistics, read_folders
from tallybook.sources.inbox import list_files
from tallybook.sources.lake import Lake, read_categorized, read_fact, read_monthly, read_silver
from tallybook.streaming.inbox_stream import ingest_files

HEAD = "Date,Details,Amount,Balance,Account\n"
JANUARY = HEAD + "2024-01-03,Corner Shop,-5.25,94.75,7\n2024-01-09,Salary,1200,1294.75,7\n"
OVERLAP = HEAD + "2024-01-09,Salary,1200,1000,7\n2024-01-28,Corner Shop,-8,,7\n2024-02-02,Rent,-700,,7\nno day,Fee,-1,,7\n"
RULES = [{"id": "shop", "value": "(?i)shop", "category": "Food"}, {"id": "rent", "value": "Rent", "category": "Home", "subcategory": "Flat"}]


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def load(spark, root, lake, batch, *files):
    for name, text in files:
        put(f"{root}/in-{batch}/{name}", text)
    found = list_files(spark, *glob.glob(f"{root}/in-{batch}/*")).collect()
    return ingest_files(spark, found, lake, batch)


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def whole(spark, lake, rules):
    build_silver(spark, lake)
    build_categorized(spark, lake, rules)
    build_gold(spark, lake)


def same_tables(spark, one, two):
    for read in (read_silver, read_categorized, read_fact, read_monthly, read_folder_statistics):
        assert rows(read(spark, one)) == rows(read(spark, two)), read.__name__


PARTS = [("b1", [("ann/a.csv", JANUARY), ("a=b %/x.csv", JANUARY)]), ("b2", [("ann/b.csv", OVERLAP)]), ("b3", [("bob/c.csv", OVERLAP)])]


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("built")
    lake = Lake(f"{root}/lake")
    for batch, files in PARTS:
        load(spark, root, lake, batch, *files)
        incremental.refresh(spark, lake, RULES)
    return lake


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """The same files, loaded and not brought any further."""
    root = tmp_path_factory.mktemp("loaded")
    lake = Lake(f"{root}/lake")
    for batch, files in PARTS:
        load(spark, root, lake, batch, *files)
    return lake


def copy(lake, root):
    shutil.copytree(lake.root, root)
    return Lake(str(root))


@pytest.fixture
def parted(built, tmp_path):
    return copy(built, f"{tmp_path}/lake")


def test_parts_equal_the_whole(spark, tmp_path, parted, loaded):
    other = copy(loaded, f"{tmp_path}/other")
    whole(spark, other, RULES)
    same_tables(spark, parted, other)
    assert read_state(spark, parted).pending == []
    assert read_silver(spark, parted).filter("profile_id = 'ann'").count() == 5


def test_a_refresh_touches_only_its_folders(spark, tmp_path, parted):
    def written():
        return {p: os.path.getmtime(p) for t in (parted.silver, parted.categorized, parted.fact) for p in glob.glob(f"{t}/**/*.parquet", recursive=True)}

    before = written()
    load(spark, tmp_path, parted, "b4", ("ann/d.csv", HEAD + "2024-02-11,Corner Shop,-3,,7\n"))
    assert incremental.refresh(spark, parted, RULES) == [("ann", 2024, 2)]
    after = written()
    assert all("profile_id=ann/year=2024/month=2/" in p for p in set(before) ^ set(after))
    assert len(set(after) - set(before)) == 3

    plan = read_folders(spark, parted.silver, SILVER, [("ann", 2024, 2), ("nobody", 1999, 1)])
    assert {os.path.dirname(p).removeprefix(f"file://{parted.silver}/") for p in plan.inputFiles()} == {"profile_id=ann/year=2024/month=2"}
    totals = {(r.profile_id, r.year, r.month, r.category): r.total_amount for r in read_monthly(spark, parted).collect()}
    assert totals["ann", 2024, 2, "Food"] == -3 and float(totals["ann", 2024, 1, "Food"]) == -13.25


def test_a_run_that_died_is_run_again(spark, tmp_path, parted, loaded, monkeypatch):
    load(spark, tmp_path, parted, "b4", ("ann/d.csv", HEAD + "2024-02-11,Corner Shop,-3,,7\n2024-03-01,Rent,-700,,7\n"))

    def die(*_):
        raise RuntimeError("lost")

    for step in ("refresh_gold", "_replace_totals", "note_folders", "write_state"):
        with monkeypatch.context() as m:
            m.setattr(incremental, step, die)
            with pytest.raises(RuntimeError):
                incremental.refresh(spark, parted, RULES)
    incremental.refresh(spark, parted, RULES)
    other = copy(loaded, f"{tmp_path}/other")
    load(spark, f"{tmp_path}/again", other, "b4", ("ann/d.csv", HEAD + "2024-02-11,Corner Shop,-3,,7\n2024-03-01,Rent,-700,,7\n"))
    whole(spark, other, RULES)
    same_tables(spark, parted, other)


def test_changed_rules_label_everything_anew(spark, tmp_path, parted):
    rules = [{"id": "pay", "value": "Salary", "category": "Income"}]
    assert incremental.refresh(spark, parted, rules) == []
    assert {r.category for r in read_fact(spark, parted).collect()} == {"Income", None}
    assert incremental.refresh(spark, parted, rules) == []


def test_bounds_open_no_data_file(spark, parted):
    facts, folders = read_fact(spark, parted), read_folder_statistics(spark, parted)
    mine = folders.filter("profile_id = 'ann'")
    bounds = ranges.date_bounds(facts, folders=mine)
    assert [tuple(r) for r in bounds.collect()] == [(date(2024, 1, 3), date(2024, 2, 2))]
    assert all("/meta/fact_folders/" in p for p in bounds.inputFiles())
    assert ranges.calendar_months(facts, folders=mine).filter("not is_disabled").count() == 2
    for preset, days in (("7d", {"2024-01-28", "2024-02-02"}), ("mtd", {"2024-02-02"}), ("default", {"2024-02-02"}), ("all", {"2024-01-03", "2024-01-09", "2024-01-28", "2024-02-02"})):
        got = ranges.in_preset(facts.filter("profile_id = 'ann'"), preset, folders=mine)
        assert {str(r.post_date) for r in got.collect()} == days, preset
    # The range is known before the facts are scanned, and cuts folders, not rows only.
    plan = ranges.in_preset(facts, "mtd", folders=mine)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line and "applied_rules" in line)
    assert "PartitionFilters" in scan and "year" in scan.split("PartitionFilters")[1] and "Subq" in scan.split("PartitionFilters")[1]


def test_statistics_follow_every_write(spark, parted):
    want = read_fact(spark, parted).groupBy("profile_id", "year", "month").agg(F.count("*").alias("rows"), F.min("post_date").alias("min_date"), F.max("post_date").alias("max_date"))
    assert rows(read_folder_statistics(spark, parted)) == rows(want)


def test_contents_index_stays_bounded(spark, tmp_path):
    lake, batches, log = Lake(f"{tmp_path}/lake"), 11, 3
    for n in range(batches):
        entries = spark.createDataFrame([("ann", f"sha-{n}"), (f"p{n % 3}", "sha-shared" if n < 3 else f"sha-more-{n}")], "profile_id string, sha256 string")
        commit_batch(spark, lake, entries, f"q-{n:04d}", log_batches=log)
        if n % 5 == 0:
            commit_batch(spark, lake, entries, f"q-{n:04d}", log_batches=log)  # a batch that came again
        state = read_state(spark, lake)
        assert len(state.log) <= log
        assert len(glob.glob(f"{lake.contents}/log-*/*/")) <= 2 * log + 2
        assert len(glob.glob(f"{lake.contents}/state/*/*.parquet")) <= 2
    assert read_state(spark, lake).pending == [f"q-{n:04d}" for n in range(batches)]
    asked = [("ann", f"sha-{n}") for n in range(batches)] + [("p0", "sha-shared"), ("p9", "sha-shared"), ("ann", "sha-x")]
    keys = spark.createDataFrame(asked, "profile_id string, sha256 string")
    known = {tuple(r)[:2] for r in known_contents(spark, lake, keys, "q-9999").collect()}
    assert known == set(asked[:-2])
    again = {tuple(r)[:2] for r in known_contents(spark, lake, keys, "q-0007").collect()}
    assert known - again == {("ann", "sha-7")}


def test_a_lake_without_an_index_takes_its_registry(spark, tmp_path):
    lake = Lake(f"{tmp_path}/lake")
    old = spark.sql("SELECT 'a.csv' AS file, 'x' AS sha256, 1L AS bytes, current_timestamp() AS ingested_at, 'ann' AS profile_id, 'q-0' AS ingest_batch")
    old.write.partitionBy("profile_id", "ingest_batch").parquet(lake.registry)
    keys = spark.createDataFrame([("ann", "x"), ("ann", "y")], "profile_id string, sha256 string")
    assert [r.sha256 for r in known_contents(spark, lake, keys, "q-1").collect()] == ["x"]


@pytest.mark.parametrize("value", ["plain", "a=b", "x/y%", "ü ñ", "[1]{2}", None, "__x"])
def test_folder_names(spark, tmp_path, value):
    table = spark.createDataFrame([(value, 1)], "p string, n int")
    table.write.partitionBy("p").parquet(f"{tmp_path}/t")
    assert folder_name("p", value) in os.listdir(f"{tmp_path}/t")
    assert [tuple(r) for r in read_folders(spark, f"{tmp_path}/t", table.schema, [(value,)], ("p",)).select("p", "n").collect()] == [(value, 1)]
