"""Ledgers over the driver's tables, for checks and timing, with the same ledgers as SQL.

``ledger``: one transaction for each lineitem, three profiles that hold about a third of the rows each.
``order_ledger``: one transaction for each order, one profile for each customer.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.operators.first_match import categorize
from tallybook.operators.rollups import fact_transactions
from tallybook.operators.standardize import dealt, dedup_transactions, standardize
from tallybook.plans.scratch import shared_folder
from tallybook.schemas import MONEY
from tallybook.sources.folders import folder_statistics, note_folders
from tallybook.sources.lake import Lake, read_fact, spread, write_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows. Size of the part table decides on its join; no hint is given."""
    lines = spread(
        table(spark, sf_dir, "lineitem").select(
            "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"
        )
    )
    price = F.col("l_extendedprice")
    return lines.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_returnflag").alias("profile_id"),
        F.concat(F.lit("ACC-"), F.col("l_suppkey")).alias("account_id"),
        F.col("l_shipdate").cast("date").alias("post_date"),
        F.when(F.col("l_linestatus") == "F", -price).otherwise(price).cast(MONEY).alias("amount"),
        F.lit("USD").alias("currency"),
        F.concat(F.lit("  "), F.col("p_name"), F.lit("   "), F.col("p_brand")).alias("description"),
        F.lit(None).cast(MONEY).alias("balance"),
    )


def order_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("C"), F.col("o_custkey")).alias("profile_id"),
        F.concat(F.lit("ORD-"), F.col("o_orderkey")).alias("account_id"),
        F.col("o_orderdate").cast("date").alias("post_date"),
        F.when(F.col("o_orderstatus") == "F", -total).otherwise(total).cast(MONEY).alias("amount"),
        F.col("o_orderpriority").alias("name"),
    )


def customer_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile for each customer; two of three share, with a person and with an office of their nation."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("position"),
        F.concat(F.lit("C"), key).alias("id"),
        F.when(
            key % 3 != 0,
            F.array(
                F.concat(F.lit("C"), F.floor(key / 2)),
                F.concat(F.lit("N"), F.col("c_nationkey")),
            ),
        ).alias("share_with"),
    )


SHOP_RULES: list[dict[str, Any]] = [
    {"id": "kitchen-hot", "value": r"(?i)\bHOT\s+(ring|plate)\b", "category": "Kitchen"},
    {"id": "metal-rods", "value": r"\brods?\b|\bbolt\b", "category": "Metal", "subcategory": "Stock"},
    {"id": "kitchen-rings", "value": r"ring|plate", "category": "Kitchen", "subcategory": "Rings"},
    {"id": "blue-line", "column": "clean_desc", "value": r"^ blue .*brand#1", "category": "Colour",
     "subcategory": "Blue"},
    {"id": "supplier-seven", "column": "account_id", "value": r"7$", "category": "Supplier"},
    {"id": "metal-anvil", "value": r"(?i)ANVIL", "category": "Metal", "subcategory": "Forged"},
    {"id": "machines", "value": r"gear", "category": "Machines", "subcategory": "Parts"},
    {"id": "machines-old", "value": r"\bold\b", "category": "Machines", "subcategory": "Used"},
]


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardized ledger; its transactions are distinct as they come."""
    return standardize(ledger(spark, sf_dir))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_transactions(categorize(silver(spark, sf_dir), SHOP_RULES))


_GOLD: dict[tuple[str, str], Lake] = {}


def gold_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """``facts`` as the reports meet them: a lake table in month folders with statistics, written once in a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _GOLD:
        lake = Lake(shared_folder(spark, "gold"))
        clean = dedup_transactions(standardize(dealt(ledger(spark, sf_dir))))
        write_table(fact_transactions(categorize(clean, SHOP_RULES)), lake.fact, regroup=False)
        note_folders(spark, lake, folder_statistics(read_fact(spark, lake)))
        _GOLD[key] = lake
    return _GOLD[key]


def gold_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_fact(spark, gold_lake(spark, sf_dir))


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and arrays as text, so that any engine can be compared with."""
    shown = []
    for field in df.schema:
        kind = field.dataType.typeName()
        c = F.col(field.name)
        shown.append(
            c.cast("double").alias(field.name) if kind == "decimal"
            else F.array_join(c, ",").alias(field.name) if kind == "array"
            else c
        )
    return df.select(*shown)


# ---------------------------------------------------------------------------------------------------- SQL

LEDGER_SQL = """ledger AS (
  SELECT l_returnflag AS profile_id, 'ACC-' || l_suppkey AS account_id, CAST(l_shipdate AS DATE) AS post_date,
         CAST(CASE WHEN l_linestatus = 'F' THEN -l_extendedprice ELSE l_extendedprice END AS DECIMAL(18,4)) AS amount,
         'USD' AS currency, '  ' || p_name || '   ' || p_brand AS description,
         CAST(NULL AS DECIMAL(18,4)) AS balance
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

_CLEAN = r"lower(regexp_replace(description, '\s+', ' ', 'g'))"
SILVER_COLUMNS_SQL = f"""*, description AS name, {_CLEAN} AS clean_desc,
         substr(sha256(concat_ws('|', profile_id, account_id, CAST(post_date AS VARCHAR),
           CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR), trim({_CLEAN}))), 1, 16) AS txn_id,
         CAST(NULL AS VARCHAR) AS merchant, FALSE AS is_transfer,
         CAST(year(post_date) AS INTEGER) AS year, CAST(month(post_date) AS INTEGER) AS month"""
SILVER_SQL = LEDGER_SQL + f",\nsilver AS (SELECT {SILVER_COLUMNS_SQL} FROM ledger)"


def text_sql(value: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if value is None else "'" + value.replace("'", "''") + "'"


def categorized_sql(source: str = "silver", rules: list[dict[str, Any]] | None = None) -> str:
    """CTEs ``flagged`` and ``categorized`` for rows without earlier labels, as CASE chains."""
    rules = SHOP_RULES if rules is None else rules
    flags = ", ".join(
        f"regexp_matches({r.get('column', 'name')}, {text_sql(r['value'])}) AS m{i}" for i, r in enumerate(rules)
    )

    def chain(value) -> str:
        return "CASE " + " ".join(f"WHEN m{i} THEN {value(i, r)}" for i, r in enumerate(rules)) + " END"

    def subcategory(i, rule) -> str:
        if rule.get("subcategory") is not None:
            return text_sql(rule["subcategory"])
        later = [
            f"WHEN m{j} THEN {text_sql(r['subcategory'])}"
            for j, r in enumerate(rules)
            if j > i and r["category"] == rule["category"] and r.get("subcategory") is not None
        ]
        return "CASE " + " ".join(later) + " END" if later else text_sql(None)

    def stamp(i, rule) -> str:
        sub = rule.get("subcategory")
        return text_sql(f"set_category:{rule['id']}:{rule['category']}" + (f"/{sub}" if sub else ""))

    hits = ", ".join(f"CASE WHEN m{i} THEN {text_sql(r['id'])} END" for i, r in enumerate(rules))
    return f""",
flagged AS (SELECT *, {flags} FROM {source}),
categorized AS (
  SELECT * EXCLUDE ({", ".join(f"m{i}" for i in range(len(rules)))}),
         {chain(lambda i, r: text_sql(r["category"]))} AS category,
         {chain(subcategory)} AS subcategory,
         nullif(concat_ws(',', {hits}), '') AS applied_rules,
         {chain(stamp)} AS operation
  FROM flagged)"""


FACTS_SQL = SILVER_SQL + categorized_sql() + ",\nfacts AS (SELECT * FROM categorized)"
FACT_COLUMNS_SQL = """profile_id, txn_id, account_id, post_date, year, month, CAST(amount AS DOUBLE) AS amount,
  currency, name, clean_desc, merchant, category, subcategory, applied_rules, operation, is_transfer,
  CAST(balance AS DOUBLE) AS balance"""

ORDERS_SQL = """order_ledger AS (
  SELECT 'C' || o_custkey AS profile_id, 'ORD-' || o_orderkey AS account_id,
         CAST(o_orderdate AS DATE) AS post_date,
         CAST(CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END AS DECIMAL(18,4)) AS amount,
         o_orderpriority AS name
  FROM orders)"""
SHARES_SQL = """pairs AS (
  SELECT c_custkey AS position, 'C' || c_custkey AS owner_profile_id, 'C' || c_custkey AS viewer_profile_id
  FROM customer
  UNION ALL
  SELECT c_custkey, 'C' || c_custkey, unnest(['C' || (c_custkey // 2), 'N' || c_nationkey])
  FROM customer WHERE c_custkey % 3 <> 0),
shares AS (SELECT owner_profile_id, viewer_profile_id FROM pairs)"""
