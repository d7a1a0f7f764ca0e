"""Ranges, drilldown and access on small ledgers; plans on a lake table."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tallybook import schemas
from tallybook.operators import access, drilldown, ranges, rollups
from tallybook.operators.standardize import dealt, dedup_transactions, standardize
from tallybook.plans import jobs
from tallybook.sinks.exports import export_transactions
from tallybook.sources.lake import Lake, read_bronze, read_fact, read_silver, write_table
from tallybook.sources.reference_data import profiles_table, read_taxonomy
from tallybook.schemas import FACT

OPEN = "spark.sql.maxConcurrentOutputFileWriters"


@pytest.fixture(scope="module")
def facts(spark):
    rows = [
        ("p", "1", date(2024, 2, 29), -10.0, "Food", "shop"),
        ("p", "2", date(2024, 3, 1), -5.5, None, "kiosk"),
        ("p", "3", date(2024, 3, 1), 8.0, "Food", ""),
        ("p", "4", date(2024, 3, 30), 100.0, "Income", "pay"),
        ("p", "5", None, -1.0, "Food", "undated"),
        ("q", "6", date(2023, 7, 4), -7.0, "Food", "other"),
    ]
    df = spark.createDataFrame(rows, "profile_id string, txn_id string, post_date date, amount double, category string, name string")
    extra = {f.name: F.lit(None).cast(f.dataType) for f in FACT if f.name not in df.columns}
    full = df.withColumns(extra).withColumns({
        "amount": F.col("amount").cast("decimal(18,4)"), "year": F.year("post_date"), "month": F.month("post_date"),
        "clean_desc": F.lower("name"),
    })
    return full.select(*FACT.names)


def ids(df):
    return sorted(r.txn_id for r in df.select("txn_id").collect())


@pytest.mark.parametrize("foldered", [False, True])
def test_presets(spark, facts, tmp_path, foldered):
    if foldered:
        lake = Lake(str(tmp_path))
        write_table(facts, lake.fact)
        facts = read_fact(spark, lake)
    p = facts.filter("profile_id = 'p'")

    def pick(preset, as_of=None, f=p):
        return ids(ranges.in_preset(f, preset, as_of, foldered))

    assert pick("7d") == ["4"]
    assert pick("30d") == ["2", "3", "4"]  # 1 March to 30 March
    assert pick("7d", date(2024, 3, 2)) == ["1", "2", "3"]
    assert pick("7d", date(2030, 1, 1)) == ["4"]  # never later than the data
    assert pick("mtd") == ["2", "3", "4"]
    assert pick("qtd", date(2024, 2, 29)) == ["1"]
    assert pick("ytd") == ["1", "2", "3", "4"]
    assert pick("default") == ["2", "3", "4"]
    assert pick("all") == ["1", "2", "3", "4"]
    assert pick("all", f=facts) == ["1", "2", "3", "4", "6"]
    bounds = ranges.date_bounds(facts, foldered).collect()[0]
    assert (bounds.min_date, bounds.max_date) == (date(2023, 7, 4), date(2024, 3, 30))
    months = ranges.calendar_months(facts, foldered).collect()
    assert len(months) == 24
    enabled = [(m.year, m.month) for m in months if not m.is_disabled]
    assert (enabled[0], enabled[-1], len(enabled)) == ((2023, 7), (2024, 3), 9)


def test_month_and_custom(facts):
    assert ids(ranges.in_month(facts, 2024, 2)) == ["1"]
    assert ids(ranges.in_custom(facts, date(2024, 2, 29), date(2024, 3, 1))) == ["1", "2", "3"]
    assert ranges.month_of_range(date(2024, 2, 1), date(2024, 2, 9)) == "2024-02"
    assert ranges.month_of_range(date(2024, 2, 1), date(2024, 3, 1)) is None
    with pytest.raises(ValueError, match="unknown preset"):
        ranges.preset_range(facts, "decade")


def test_rollups(facts):
    daily = {r.post_date: r.spend for r in rollups.daily_spend(facts).collect()}
    assert daily == {date(2023, 7, 4): 7, date(2024, 2, 29): 10, date(2024, 3, 1): Decimal("5.5"), date(2024, 3, 30): 0}
    spend = [(r.category, float(r.total)) for r in rollups.category_spend(facts).collect()]
    assert spend == [("Food", 18.0), ("Uncategorized", 5.5)]
    share = rollups.category_share(facts).collect()
    assert [round(r.share, 4) for r in share] == [0.766, 0.234] and all(r.is_labelled for r in share)
    assert rollups.total_spend(facts.filter("false")).collect()[0].total_spend == 0
    monthly = rollups.category_monthly(facts)
    assert {(r.category, float(r.spend)) for r in rollups.spend_only(monthly.filter("year = 2024")).collect()} == {
        ("Food", 10.0), (None, 5.5),
    }


def test_drilldown(facts):
    assert ids(drilldown.in_category(facts, "Uncategorized")) == ["2"]
    assert ids(drilldown.on_day(facts, date(2024, 3, 1))) == ["2", "3"]
    rows = drilldown.detail_rows(drilldown.on_day(facts, date(2024, 3, 1))).collect()
    assert [(r.label, r.category, r.merchant) for r in rows] == [("kiosk", "—", "—"), (None, "Food", "—")]


def test_access(spark, facts):
    profiles = profiles_table(spark, [{"id": "p", "share_with": ["q"]}, {"id": "q"}, {"id": "r", "share_with": ["q", "r"]}])
    shares = access.share_index(profiles)
    pairs = [tuple(r) for r in shares.collect()]
    assert sorted(pairs) == [("p", "p"), ("p", "q"), ("q", "q"), ("r", "q"), ("r", "r"), ("r", "r")]
    assert ids(access.visible_facts(facts, shares, "q")) == ["1", "2", "3", "4", "5", "6"]
    assert ids(access.visible_facts(facts, shares, "r")) == []
    assert {tuple(r) for r in access.default_owners(profiles, "position").collect()} == {("p", "p"), ("q", "p"), ("r", "r")}
    assert sorted(r[0] for r in access.owners_of(shares, "r").collect()) == ["r"]
    assert sorted(r[0] for r in access.viewers_of(shares).collect()) == ["p", "q", "r"]


def test_taxonomy(spark, tmp_path):
    (tmp_path / "t.csv").write_text('category,subcategory,description\nFun,Video,Films, series\nFun,Music,"Songs, albums"\n')
    assert {tuple(r) for r in read_taxonomy(spark, str(tmp_path / "t.csv")).collect()} == {
        ("Fun", "Video", "Films, series"), ("Fun", "Music", "Songs, albums"),
    }


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_range_reports_read_only_their_folders(spark, facts, tmp_path):
    lake = Lake(str(tmp_path))
    write_table(facts, lake.fact)
    month = ranges.in_month(read_fact(spark, lake).filter("profile_id = 'p'"), 2024, 3)
    month.collect()
    plan = physical(month)
    assert "(profile_id" in plan.split("PartitionFilters")[1] and "year" in plan.split("PartitionFilters")[1]
    preset = ranges.in_preset(read_fact(spark, lake), "mtd", foldered=True)
    plan = physical(preset)
    assert "year" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]


def test_dedup_keeps_one_of_each_by_a_total_order(spark):
    rows = [("a", "acc", "2024-01-05", "1.00", "Shop", b) for b in (None, "9", "3")] * 4
    rows += [("a", "acc", "2024-01-05", "1.00", "shop ", "2"), ("b", "acc", "2024-01-05", "1.00", "Shop", None)]
    bronze = spark.createDataFrame(rows, "profile_id string, account_id string, post_date string, amount string, description string, balance string")
    silver = standardize(bronze.withColumn("currency", F.lit(None).cast("string")))
    for parts in (1, 5):
        got = dedup_transactions(silver.repartition(parts)).select("profile_id", "balance").collect()
        assert {(r.profile_id, r.balance) for r in got} == {("a", 2), ("b", None)}


def test_silver_runs_without_python_and_limits_copies_before_the_shuffle(spark):
    bronze = spark.sql("SELECT 'p' AS profile_id, 'a' AS account_id, string(id) AS post_date, '1' AS amount, 'c' AS currency, 'd' AS description, '1' AS balance FROM range(9)")
    plan = physical(dedup_transactions(standardize(bronze)))
    assert "Python" not in plan
    before = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before


def _sent(spark):
    """Copies in two files with real repeats, other spellings, other spaces, nulls and empty texts."""
    shop = ("Shop", "shop ", " SHOP", "S  hop", "S\thop", None, "", "sh|op", "2024-01-05|1.00|shop")
    rows = [
        (p, a, d, m, text, b, f, f)
        for p in ("p", None) for a in ("acc", None, "", "a|2024-01-05|1.00") for d in ("2024-01-05", None, "no day") for m in ("1.00", "1.004", None)
        for text in shop for b, f in ((None, "a"), ("2", "a"), ("1", "b"), (None, "b"), (None, "b"))
    ]
    names = ("profile_id", "account_id", "post_date", "amount", "description", "balance", "source_file", "source_sha256")
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)).withColumn("currency", F.lit("EUR"))


def test_dealt_rows_have_the_same_survivors_and_are_moved_once(spark):
    bronze = _sent(spark)
    for repeats in (False, True):
        want = sorted(map(repr, dedup_transactions(standardize(bronze), repeats).collect()))
        for by_folder in (False, True):
            got = dedup_transactions(standardize(dealt(bronze, by_folder)), repeats)
            assert sorted(map(repr, got.collect())) == want
            assert physical(got).split("Initial Plan")[-1].count("Exchange ") == 1
    assert physical(dedup_transactions(standardize(bronze), True)).split("Initial Plan")[-1].count("Exchange ") == 1


def test_repeats_move_only_what_orders_and_what_is_selected(spark):
    shown = dedup_transactions(standardize(dealt(_sent(spark), by_folder=False)), True).select("txn_id", "amount", "occurrence")
    moved = physical(shown).split("Exchange hashpartitioning")[1]
    assert "sha2(" not in moved and "merchant" not in physical(shown)


def test_silver_is_grouped_and_freed_of_copies_by_one_exchange_and_written_unsorted(spark, tmp_path, monkeypatch):
    rows = _sent(spark).withColumns({"ingest_batch": F.lit("1"), "unread": F.lit(None).cast(schemas.UNREAD)})
    lake = Lake(str(tmp_path))
    write_table(rows.withColumns({c: F.col(c).cast(schemas.MONEY) for c in ("amount", "balance")}), lake.bronze, by=("profile_id", "ingest_batch"))
    written = []
    save = DataFrameWriter.save
    monkeypatch.setattr(DataFrameWriter, "save", lambda self, *a, **k: (written.append((physical(self._df), spark.conf.get(OPEN))), save(self, *a, **k))[1])
    before = spark.conf.get(OPEN)
    jobs.build_silver(spark, lake)
    assert spark.conf.get(OPEN) == before and written[0][1] != before
    assert written[0][0].split("Initial Plan")[-1].count("Exchange ") == 1
    want = dedup_transactions(standardize(read_bronze(spark, lake)))
    assert sorted(map(repr, read_silver(spark, lake).select(*want.columns).collect())) == sorted(map(repr, want.collect()))


def test_large_profiles_are_exported_without_an_exchange(spark, facts, tmp_path):
    some = facts.repartition(3)
    for large in (10**9, 1):
        export_transactions(some, str(tmp_path / str(large)), large)
    few, many = (spark.read.option("header", True).csv(str(tmp_path / str(n))) for n in (10**9, 1))
    assert sorted(map(repr, few.collect())) == sorted(map(repr, many.collect()))
    assert len(few.inputFiles()) == few.select("profile").distinct().count() < len(many.inputFiles())
