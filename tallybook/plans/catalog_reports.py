"""Queries over the reports, ranges and access rules, each with the SQL it must agree with."""

from __future__ import annotations

from datetime import date
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.operators import access, drilldown, ranges, rollups
from tallybook.plans.scratch import shared_folder
from tallybook.plans.testbed import (
    FACTS_SQL,
    ORDERS_SQL,
    SHARES_SQL,
    customer_profiles,
    gold_facts,
    gold_lake,
    order_ledger,
    plain,
    silver,
    table,
)
from tallybook.schemas import SHARES
from tallybook.sinks.exports import export_share_index
from tallybook.sources.folders import read_folder_statistics
from tallybook.sources.lake import read_fact
from tallybook.sources.reference_data import load_profiles_yaml

_F = f"WITH {FACTS_SQL}"
_SPEND = "CAST(sum(-least(amount, 0)) AS DOUBLE)"
_LABEL = "coalesce(category, 'Uncategorized')"


def _on_facts(report):
    return lambda spark, sf_dir: plain(report(gold_facts(spark, sf_dir)))


def _on_folders(report):
    """Reports that take bounds from the folder statistics."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake = gold_lake(spark, sf_dir)
        return plain(report(read_fact(spark, lake), read_folder_statistics(spark, lake)))

    return run


def distinct_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.profiles_of(silver(spark, sf_dir))


def _detail_sql(where: str) -> str:
    return f"""{_F} SELECT post_date, name AS label, coalesce(category, '—') AS category, '—' AS merchant,
  CAST(amount AS DOUBLE) AS amount, txn_id FROM facts WHERE {where}"""


DAY = date(1999, 3, 14)
AS_OF = date(2000, 5, 17)
_RANGE_COLUMNS = ("txn_id", "profile_id", "post_date", "amount", "category")


def _range_query(pick):
    return lambda spark, sf_dir: plain(pick(gold_facts(spark, sf_dir)).select(*_RANGE_COLUMNS))


def _preset_query(preset: str, as_of: date | None = None):
    return _on_folders(lambda f, folders: ranges.in_preset(f, preset, as_of, folders=folders).select(*_RANGE_COLUMNS))


def _range_sql(start: str, end: str) -> str:
    return f"""{_F}, b AS (SELECT min(post_date) AS lo, max(post_date) AS hi,
  least(max(post_date), DATE '{AS_OF}') AS as_of FROM facts)
SELECT txn_id, profile_id, post_date, CAST(amount AS DOUBLE) AS amount, category FROM facts, b
WHERE post_date BETWEEN {start} AND {end}"""


def _visible(viewer: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        shares = access.share_index(customer_profiles(spark, sf_dir))
        return plain(access.visible_facts(order_ledger(spark, sf_dir), shares, viewer))

    return run


def share_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.share_index(customer_profiles(spark, sf_dir))


def share_index_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share index as a file, read back."""
    path = shared_folder(spark, "shares")
    export_share_index(share_index(spark, sf_dir), path)
    return spark.read.schema(SHARES).option("header", True).csv(path)


def share_index_yaml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles from a YAML file: nations that share with their region, but for the first of each alphabet half."""
    path = shared_folder(spark, "profiles")
    share = F.when(F.col("n_nationkey") % 13 == 0, "").otherwise(F.concat(F.lit("\n    share_with: [R"), "n_regionkey", F.lit(", audit]")))
    entry = F.concat(F.lit("  - id: N"), "n_nationkey", F.lit("\n    display_name: "), "n_name", share)
    text = table(spark, sf_dir, "nation").agg(F.concat(F.lit("profiles:\n"), F.array_join(F.array_sort(F.collect_list(entry)), "\n")).alias("value"))
    text.coalesce(1).write.text(path)
    return access.share_index(load_profiles_yaml(spark, path))


def viewer_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.owners_of(share_index(spark, sf_dir), "N7")


def viewers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.viewers_of(share_index(spark, sf_dir))


def default_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.default_owners(customer_profiles(spark, sf_dir), "position")


def viewer_month_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a viewer sees first: the newest month of the visible owners, spend by owner."""
    shares = access.share_index(customer_profiles(spark, sf_dir))
    seen = ranges.in_preset(access.visible_facts(order_ledger(spark, sf_dir), shares, "N3"), "default")
    return plain(seen.groupBy("profile_id").agg(F.sum("amount").alias("net"), F.count("*").alias("n")))


QUERIES = {
    "daily_spend": (_on_facts(rollups.daily_spend), f"{_F} SELECT post_date, {_SPEND} AS spend FROM facts GROUP BY post_date"),
    "daily_net": (
        _on_facts(rollups.daily_net), f"{_F} SELECT post_date, CAST(sum(amount) AS DOUBLE) AS net FROM facts GROUP BY post_date"
    ),
    "category_spend": (
        _on_facts(rollups.category_spend),
        f"{_F} SELECT {_LABEL} AS category, {_SPEND} AS total FROM facts GROUP BY 1 HAVING {_SPEND} > 0",
    ),
    "category_share": (
        _on_facts(rollups.category_share),
        f"""{_F}, t AS (SELECT {_LABEL} AS category, sum(-least(amount, 0)) AS total FROM facts GROUP BY 1)
SELECT category, CAST(total AS DOUBLE) AS total,
  CAST(total AS DOUBLE) / CAST(sum(total) OVER () AS DOUBLE) AS share,
  CAST(total AS DOUBLE) / CAST(sum(total) OVER () AS DOUBLE) > 0.07 AS is_labelled FROM t WHERE total > 0""",
    ),
    "drill_category": (
        _on_facts(lambda f: drilldown.detail_rows(drilldown.in_category(f, "Uncategorized"))), _detail_sql("category IS NULL"),
    ),
    "drill_category_daily": (
        _on_facts(lambda f: rollups.daily_spend(drilldown.in_category(f, "Metal"))),
        f"{_F} SELECT post_date, {_SPEND} AS spend FROM facts WHERE category = 'Metal' GROUP BY post_date",
    ),
    "drill_day": (
        _on_facts(lambda f: drilldown.detail_rows(drilldown.on_day(f, DAY))), _detail_sql(f"post_date = DATE '{DAY}'"),
    ),
    "drill_total": (
        _on_facts(lambda f: rollups.total_spend(drilldown.in_category(f, "Kitchen"))),
        f"{_F} SELECT {_SPEND} AS total_spend FROM facts WHERE category = 'Kitchen'",
    ),
    "date_bounds": (_on_folders(lambda f, folders: ranges.date_bounds(f, folders=folders)), f"{_F} SELECT min(post_date) AS min_date, max(post_date) AS max_date FROM facts"),
    "calendar_months": (
        _on_folders(lambda f, folders: ranges.calendar_months(f, folders=folders)),
        f"""{_F}, b AS (SELECT min(post_date) AS lo, max(post_date) AS hi FROM facts),
m AS (SELECT lo, hi, CAST(unnest(generate_series(date_trunc('year', lo)::TIMESTAMP,
  (date_trunc('year', hi) + INTERVAL 11 MONTH)::TIMESTAMP, INTERVAL 1 MONTH)) AS DATE) AS d FROM b)
SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, d AS first_day, last_day(d) AS last_day,
  last_day(d) < lo OR d > hi AS is_disabled FROM m""",
    ),
    "range_last_7d": (_preset_query("7d"), _range_sql("hi - 6", "hi")),
    "range_last_30d": (
        _preset_query("30d", AS_OF), _range_sql("as_of - 29", "as_of"),
    ),
    "range_mtd": (_preset_query("mtd", AS_OF), _range_sql("date_trunc('month', as_of)", "as_of")),
    "range_qtd": (_preset_query("qtd", AS_OF), _range_sql("date_trunc('quarter', as_of)", "as_of")),
    "range_ytd": (_preset_query("ytd", AS_OF), _range_sql("date_trunc('year', as_of)", "as_of")),
    "range_all": (_preset_query("all"), _range_sql("lo", "hi")),
    "range_default": (_preset_query("default"), _range_sql("date_trunc('month', hi)", "last_day(hi)")),
    "range_month": (
        _range_query(lambda f: ranges.in_month(f, 2000, 2)), _range_sql("DATE '2000-02-01'", "DATE '2000-02-29'"),
    ),
    "range_custom": (
        _range_query(lambda f: ranges.in_custom(f, date(1997, 11, 20), date(1998, 1, 5))),
        _range_sql("DATE '1997-11-20'", "DATE '1998-01-05'"),
    ),
    "share_index": (share_index, f"WITH {SHARES_SQL} SELECT * FROM shares"),
    "share_index_export": (share_index_export, f"WITH {SHARES_SQL} SELECT * FROM shares"),
    **({} if find_spec("yaml") is None else {"share_index_yaml": (
        share_index_yaml,
        """SELECT 'N' || n_nationkey AS owner_profile_id, unnest(CASE WHEN n_nationkey % 13 = 0 THEN ['N' || n_nationkey]
         ELSE ['N' || n_nationkey, 'R' || n_regionkey, 'audit'] END) AS viewer_profile_id FROM nation""",
    )}),
    "viewers": (viewers, f"WITH {SHARES_SQL} SELECT DISTINCT viewer_profile_id FROM shares"),
    "viewer_owners": (
        viewer_owners, f"WITH {SHARES_SQL} SELECT DISTINCT owner_profile_id FROM shares WHERE viewer_profile_id = 'N7'"
    ),
    "default_owner": (
        default_owner,
        f"WITH {SHARES_SQL} SELECT viewer_profile_id, arg_min(owner_profile_id, position) AS owner_profile_id FROM pairs GROUP BY 1",
    ),
    "visible_facts": (
        _visible("N3"),
        f"""WITH {ORDERS_SQL}, {SHARES_SQL}
SELECT profile_id, account_id, post_date, CAST(amount AS DOUBLE) AS amount, name FROM order_ledger
WHERE profile_id IN (SELECT owner_profile_id FROM shares WHERE viewer_profile_id = 'N3')""",
    ),
    "viewer_month_spend": (
        viewer_month_spend,
        f"""WITH {ORDERS_SQL}, {SHARES_SQL}, seen AS (SELECT * FROM order_ledger
  WHERE profile_id IN (SELECT owner_profile_id FROM shares WHERE viewer_profile_id = 'N3'))
SELECT profile_id, CAST(sum(amount) AS DOUBLE) AS net, count(*) AS n FROM seen
WHERE post_date >= (SELECT date_trunc('month', max(post_date)) FROM seen) GROUP BY profile_id""",
    ),
    "folder_statistics": (
        _on_folders(lambda f, folders: folders),
        f"{_F} SELECT profile_id, year, month, count(*) AS rows, min(post_date) AS min_date, max(post_date) AS max_date FROM facts GROUP BY ALL",
    ),
    "distinct_profiles": (distinct_profiles, "SELECT DISTINCT l_returnflag AS profile_id FROM lineitem JOIN part ON l_partkey = p_partkey"),
}
