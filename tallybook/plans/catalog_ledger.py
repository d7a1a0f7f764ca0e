"""Queries over the cleaning steps, marts and files, each with the SQL it must agree with."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions.dates import with_parsed_date
from tallybook.functions.money import money_text, signed_amount, to_money
from tallybook.operators.canonicalize import canonicalize, unread_values
from tallybook.operators.first_match import categorize
from tallybook.operators.rollups import category_monthly, fact_transactions, spend_only
from tallybook.operators.standardize import dealt, dedup_transactions, standardize
from tallybook.plans import jobs
from tallybook.plans.scratch import shared_folder
from tallybook.plans.testbed import (
    FACT_COLUMNS_SQL,
    FACTS_SQL,
    LEDGER_SQL,
    SHOP_RULES,
    SILVER_COLUMNS_SQL,
    SILVER_SQL,
    categorized_sql,
    facts,
    gold_facts,
    ledger,
    plain,
    silver,
    table,
)
from tallybook.schemas import MONEY, REGISTRY
from tallybook.sinks.exports import TRANSACTION_COLUMNS, export_all
from tallybook.sources.inbox import line_digests, new_contents
from tallybook.sources.lake import Lake, read_bronze, read_fact, read_monthly, read_table, spread, write_table
from tallybook.sources.reference_data import read_taxonomy
from tallybook.streaming.inbox_stream import ingest_inbox

SILVER_SHOWN = (
    "profile_id", "txn_id", "account_id", "post_date", "amount", "currency", "description", "name", "clean_desc",
    "balance", "merchant", "category", "is_transfer", "year", "month",
)


def monthly_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way: standardize, key, remove duplicates, label, total by month."""
    clean = dedup_transactions(standardize(ledger(spark, sf_dir)))
    return plain(category_monthly(fact_transactions(categorize(clean, SHOP_RULES))))


def standardize_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(silver(spark, sf_dir).select(*SILVER_SHOWN))


# Spellings in which the dates of ``parse_mixed_dates`` are written, with the SQL pattern of each.
DATE_SPELLINGS = [
    ("yyyy-MM-dd", "%Y-%m-%d"), ("yyyyMMdd", "%Y%m%d"), ("MM/dd/yyyy", "%m/%d/%Y"), ("d MMM yyyy", "%-d %b %Y"),
    ("MMMM d, yyyy", "%B %-d, %Y"), ("yyyy/M/d HH:mm:ss", "%Y/%-m/%-d %H:%M:%S"), ("dd-MMM-yyyy", "%d-%b-%Y"),
]


def parse_mixed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    text = F
    for i, (pattern, _) in enumerate(DATE_SPELLINGS):
        text = text.when(key % (len(DATE_SPELLINGS) + 1) == i, F.date_format(day, pattern))
    orders = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"))
    written = orders.select(key, text.otherwise("on order").alias("written"))
    return with_parsed_date(written, "written", "post_date")


def _parse_mixed_dates_sql() -> str:
    n = len(DATE_SPELLINGS)
    written = " ".join(
        f"WHEN o_orderkey % {n + 1} = {i} THEN strftime(o_orderdate, '{p}')" for i, (_, p) in enumerate(DATE_SPELLINGS)
    )
    read = ", ".join(f"try_strptime(written, '{p}')" for _, p in DATE_SPELLINGS)
    return f"""WITH texts AS (SELECT o_orderkey, CASE {written} ELSE 'on order' END AS written FROM orders)
SELECT o_orderkey, written, CAST(coalesce({read}) AS DATE) AS post_date FROM texts"""


def signed_amount_debit_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Debits written with either sign, and text that is no number."""
    c = F.col
    debit = F.when(c("l_linestatus") == "F", F.when(c("l_tax") > 0.04, -c("l_extendedprice")).otherwise(c("l_extendedprice")))
    credit = F.when(c("l_linestatus") == "O", c("l_extendedprice").cast(MONEY))
    sides = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(c("l_quantity") == 1, F.lit("n/a")).otherwise(debit.cast(MONEY).cast("string")).alias("debit"),
        credit.cast("string").alias("credit"),
    )
    return plain(sides.select("l_orderkey", "l_linenumber", signed_amount(c("credit"), c("debit")).alias("amount")))


def amounts_lossless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts of up to 15 digits before the point and 8 behind it, read and written again."""
    whole = (F.col("l_orderkey") * 1000003 + F.col("l_linenumber")) * 98765 % 10**15
    text = F.concat(whole.cast("string"), F.lit("."), F.lpad((F.col("l_partkey") * 7919 * 10 % 10**8).cast("string"), 8, "0"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", text.alias("written"))
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", money_text(to_money(F.col("written"))).alias("amount"))


def unread_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What statements hold in amount columns that is no amount, beside the rows themselves."""
    odd = F.when(F.col("l_quantity") == 1, "n/a").when(F.col("l_quantity") == 2, "1,234.50").when(F.col("l_quantity") == 3, "0.000000001")
    odd = odd.when(F.col("l_quantity") == 4, "99999999999999999999999999").otherwise(F.col("l_extendedprice").cast("string"))
    raw = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("profile_id"),
        F.lit("b-1").alias("ingest_batch"),
        F.concat(F.lit("f"), "l_suppkey", F.lit(".csv")).alias("source_file"),
        F.lit("").alias("source_sha256"),
        F.col("l_shipdate").cast("date").cast("string").alias("Posting Date"),
        F.col("l_linestatus").alias("Details"),
        odd.alias("Amount"),
        F.when(F.col("l_discount") == 0, "--").alias("Balance"),
    )
    keep = ("profile_id", "ingest_batch", "source_file", "source_sha256")
    return unread_values(canonicalize(raw, keep, with_unread=True))


UNREAD_SQL = """WITH raw AS (
  SELECT l_returnflag AS profile_id, 'b-1' AS ingest_batch, 'f' || l_suppkey || '.csv' AS source_file, '' AS source_sha256,
    CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS post_date, l_linestatus AS description, l_quantity, l_discount FROM lineitem)
SELECT * EXCLUDE (l_quantity, l_discount), 'amount' AS role,
  CASE l_quantity WHEN 1 THEN 'n/a' WHEN 2 THEN '1,234.50' WHEN 3 THEN '0.000000001' ELSE '99999999999999999999999999' END AS text,
  CASE l_quantity WHEN 3 THEN 'rounded' WHEN 4 THEN 'too large' ELSE 'no number' END AS reason
FROM raw WHERE l_quantity IN (1, 2, 3, 4)
UNION ALL SELECT * EXCLUDE (l_quantity, l_discount), 'balance', '--', 'no number' FROM raw WHERE l_discount = 0"""


def canonicalize_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three whole tables with three kinds of header, in one canonical shape."""
    single = table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").cast("string").alias("Posting Date"),
        F.col("l_extendedprice").cast("string").alias("AMOUNT"),
        F.col("l_tax").cast("string").alias("Value"),  # a second choice for the amount, not used
        F.col("l_returnflag").alias("Details"),
        F.col("l_suppkey").cast("string").alias("Acct No"),
    )
    is_out = F.col("o_orderstatus") == "F"
    total = F.col("o_totalprice").cast("string")
    sided = table(spark, sf_dir, "orders").select(
        F.when(is_out, total).alias("Withdrawal Amt."),
        F.when(~is_out, total).alias("Deposit Amt."),
        F.col("o_orderdate").cast("date").cast("string").alias("Txn_Date"),
        F.col("o_orderpriority").alias("NARRATION"),
        F.col("o_custkey").cast("string").alias("Account Number"),
        F.lit("EUR").alias("Curr"),
    )
    no_amount = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("Remarks"), F.col("c_acctbal").cast("string").alias("Closing Balance")
    )
    parts = [canonicalize(t) for t in (single, sided, no_amount)]
    return plain(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def dedup_transactions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transaction twice, the second time with a balance and another spelling."""
    once = ledger(spark, sf_dir)
    again = once.withColumns({
        "balance": F.lit("10.5").cast(MONEY),
        "description": F.concat(F.upper("description"), F.lit(" ")),
    })
    clean = dedup_transactions(standardize(once.unionByName(again)))
    return plain(clean.select("txn_id", "profile_id", "post_date", "amount", "description", "balance"))


def dedup_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three statements that overlap: one has every payment twice, one every large receipt three times."""
    once = ledger(spark, sf_dir)

    def sent(name: str, balance: float | None, rows: DataFrame) -> DataFrame:
        return rows.withColumns({"source_file": F.lit(name), "source_sha256": F.lit(name), "balance": F.lit(balance).cast(MONEY)})

    paid, large = once.filter("amount < 0"), once.filter("amount > 50000")
    files = [sent("a", None, once), sent("a", 1.5, paid), sent("b", 2.5, once), sent("b", 3.5, large.unionByName(large)), sent("c", 0.5, once)]
    sent_rows = dealt(reduce(DataFrame.unionByName, files), by_folder=False)
    clean = dedup_transactions(standardize(sent_rows), repeats=True)
    return plain(clean.select("txn_id", "profile_id", "post_date", "amount", "balance", "source_file", "occurrence"))


REPEATS_SQL = f"""WITH {LEDGER_SQL},
sent AS (
  SELECT * EXCLUDE (balance), 'a' AS source_file, CAST(NULL AS DOUBLE) AS balance FROM ledger
  UNION ALL SELECT * EXCLUDE (balance), 'a', 1.5 FROM ledger WHERE amount < 0
  UNION ALL SELECT * EXCLUDE (balance), 'b', 2.5 FROM ledger
  UNION ALL SELECT ledger.* EXCLUDE (balance), 'b', 3.5 FROM ledger, range(2) WHERE amount > 50000
  UNION ALL SELECT * EXCLUDE (balance), 'c', 0.5 FROM ledger),
silver AS (SELECT {SILVER_COLUMNS_SQL} FROM sent),
numbered AS (SELECT *, row_number() OVER (
  PARTITION BY txn_id, profile_id, post_date, source_file ORDER BY balance NULLS LAST, amount, description) AS occurrence FROM silver),
ranked AS (SELECT *, row_number() OVER (
  PARTITION BY txn_id, profile_id, post_date, occurrence ORDER BY balance NULLS LAST, amount, description, source_file) AS n FROM numbered)
SELECT txn_id, profile_id, post_date, CAST(amount AS DOUBLE) AS amount, balance, source_file, CAST(occurrence AS INTEGER) AS occurrence
FROM ranked WHERE n = 1"""


DEDUP_SQL = f"""WITH {LEDGER_SQL},
doubled AS (
  SELECT * FROM ledger UNION ALL BY NAME
  SELECT * REPLACE (upper(description) || ' ' AS description, CAST(10.5 AS DECIMAL(18,4)) AS balance) FROM ledger),
silver AS (SELECT {SILVER_COLUMNS_SQL} FROM doubled),
numbered AS (
  SELECT *, row_number() OVER (
    PARTITION BY txn_id, profile_id, post_date ORDER BY balance NULLS LAST, amount NULLS LAST, description NULLS LAST
  ) AS copy_no FROM silver)
SELECT txn_id, profile_id, post_date, CAST(amount AS DOUBLE) AS amount, description, CAST(balance AS DOUBLE) AS balance
FROM numbered WHERE copy_no = 1"""

MONTHLY_SQL = f"""WITH {SILVER_SQL},
numbered AS (SELECT *, row_number() OVER (PARTITION BY txn_id ORDER BY description) AS copy_no FROM silver),
clean AS (SELECT * EXCLUDE (copy_no) FROM numbered WHERE copy_no = 1)
{categorized_sql("clean")}
SELECT profile_id, year, month, category, subcategory, CAST(sum(amount) AS DOUBLE) AS total_amount
FROM categorized GROUP BY ALL"""


def fact_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(facts(spark, sf_dir))


def category_monthly_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(category_monthly(facts(spark, sf_dir)))


def spend_only_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(spend_only(category_monthly(facts(spark, sf_dir))))


def file_registry_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of their source; those with a label are in the registry already."""
    files = table(spark, sf_dir, "documents").select(
        F.col("source").alias("profile_id"),
        F.format_string("doc-%012d", "doc_id").alias("file"),
        F.sha2(F.col("text").cast("binary"), 256).alias("sha256"),
        F.octet_length("text").alias("length"),
        "doc_id",
    )
    registry = files.join(table(spark, sf_dir, "labels"), "doc_id", "left_semi")
    return new_contents(files.drop("doc_id"), registry).select("profile_id", "file", "sha256", "length")


FILE_REGISTRY_SQL = """WITH files AS (
  SELECT doc_id, source AS profile_id, printf('doc-%012d', doc_id) AS file, sha256(text) AS sha256,
         CAST(octet_length(encode(text)) AS INTEGER) AS length FROM documents),
numbered AS (SELECT *, row_number() OVER (PARTITION BY profile_id, sha256 ORDER BY file) AS n FROM files)
SELECT profile_id, file, sha256, length FROM numbered f
WHERE n = 1 AND NOT EXISTS (
  SELECT 1 FROM files r JOIN labels l ON r.doc_id = l.doc_id
  WHERE r.profile_id = f.profile_id AND r.sha256 = f.sha256)"""


def content_line_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of large files, here of the lines of every document."""
    lines = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("uri"), F.explode(F.split("text", "\n")).alias("value")
    )
    return line_digests(lines, "uri")


LINE_DIGEST_SQL = """WITH lines AS (
  SELECT doc_id AS uri, sha256(unnest(string_split(text, chr(10)))) AS h FROM documents),
sums AS (
  SELECT uri, count(*) AS n, """ + ", ".join(
    f"sum(CAST(('0x' || substr(h, {1 + 15 * i}, 15)) AS HUGEINT)) AS s{i}" for i in range(4)
) + """ FROM lines GROUP BY uri)
SELECT uri, sha256(concat_ws('-', n, s0, s1, s2, s3)) AS sha256 FROM sums"""


def statement_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The ledger as statements: money out with debit and credit columns, money in with one amount."""
    rows = ledger(spark, sf_dir).withColumn("owner", F.col("profile_id"))
    sided = rows.filter("amount < 0").select(
        F.col("post_date").alias("Date"),
        F.col("description").alias("Narration"),
        (-F.col("amount")).alias("Withdrawal Amt."),
        F.lit(None).cast("string").alias("Deposit Amt."),
        F.col("account_id").alias("Account No"),
        "owner",
    )
    single = rows.filter("amount >= 0").select(
        F.col("post_date").alias("Posting Date"),
        F.col("description").alias("Details"),
        F.col("amount").alias("Amount"),
        F.col("currency").alias("Currency"),
        F.col("account_id").alias("Account"),
        "owner",
    )
    return sided, single


def write_statements(part: DataFrame, inbox: str) -> None:
    writer = part.hint("rebalance", "owner").write.mode("append").partitionBy("owner").option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).csv(inbox)


def write_inbox(spark: SparkSession, sf_dir: str, inbox: str) -> None:
    for part in statement_parts(spark, sf_dir):
        write_statements(part, inbox)


def inbox_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statement files through the inbox stream, twice: the second run finds nothing new."""
    root = shared_folder(spark, "inbox")
    write_inbox(spark, sf_dir, f"{root}/inbox")
    lake = Lake(f"{root}/lake")
    for run in ("first", "second"):
        # Separate checkpoints, so the second run sees every file again and only the registry stops it.
        ingest_inbox(spark, f"{root}/inbox", lake, f"{root}/checkpoint-{run}").awaitTermination()
    bronze = read_bronze(spark, lake)
    return plain(bronze.select("profile_id", "account_id", "post_date", "amount", "currency", "description"))


INBOX_SQL = f"""WITH {LEDGER_SQL}
SELECT 'owner=' || profile_id AS profile_id, account_id, CAST(post_date AS VARCHAR) AS post_date,
       CAST(amount AS DOUBLE) AS amount, CASE WHEN amount >= 0 THEN currency END AS currency, description
FROM ledger"""


_BUILT: dict[tuple[str, ...], Any] = {}


def _once(name: str, spark: SparkSession, sf_dir: str, build):
    """Result of a build step that several queries read, made once in a session."""
    key = (name, spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        _BUILT[key] = build(spark, sf_dir)
    return _BUILT[key]


def _lake_from_ledger(spark: SparkSession, sf_dir: str) -> Lake:
    lake = Lake(shared_folder(spark, "lake"))
    bronze = ledger(spark, sf_dir).withColumns({
        "post_date": F.col("post_date").cast("string"), "source_file": F.lit("ledger"), "source_sha256": F.lit(""), "ingest_batch": F.lit("0"),
    })
    write_table(bronze, lake.bronze, by=("profile_id", "ingest_batch"))
    jobs.build_silver(spark, lake)
    jobs.build_categorized(spark, lake, SHOP_RULES)
    jobs.build_gold(spark, lake)
    return lake


def lake_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze, silver, labelled and gold tables written and read back."""
    return plain(read_fact(spark, _once("lake", spark, sf_dir, _lake_from_ledger)))


def lake_roundtrip_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(read_monthly(spark, _once("lake", spark, sf_dir, _lake_from_ledger)))


def _write_exports(spark: SparkSession, sf_dir: str) -> str:
    out = shared_folder(spark, "exports")
    rows = gold_facts(spark, sf_dir)
    export_all(rows, category_monthly(rows), out)
    return out


def _exports(spark: SparkSession, sf_dir: str) -> str:
    return _once("exports", spark, sf_dir, _write_exports)


def export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions export, read back from CSV."""
    out = _exports(spark, sf_dir)
    text = spark.read.schema(", ".join(f"{c} string" for c in (*TRANSACTION_COLUMNS, "profile")))
    back = text.option("header", True).csv(f"{out}/transactions")
    return back.select(
        "profile",
        *[c for c in TRANSACTION_COLUMNS if c not in ("post_date", "amount", "is_transfer")],
        F.col("post_date").cast("date").alias("post_date"),
        F.col("amount").cast("double").alias("amount"),
        F.col("is_transfer").cast("boolean").alias("is_transfer"),
    )


# CSV files hold text without the blanks around it.
EXPORT_SQL = f"""WITH {FACTS_SQL}
SELECT profile_id AS profile, profile_id, txn_id, account_id, currency, trim(name) AS name, trim(clean_desc) AS clean_desc,
       merchant, category, subcategory, operation, post_date, CAST(amount AS DOUBLE) AS amount, is_transfer
FROM facts"""


def export_monthly_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _exports(spark, sf_dir)
    schema = "profile_id string, year int, month int, category string, subcategory string, total_amount double, profile string"
    return spark.read.schema(schema).option("header", True).csv(f"{out}/category_monthly")


def inbox_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements of two runs: what the first has loaded is archived when the second starts. Rows of the archived files, by
    owner, for files that the registry knows."""
    root = shared_folder(spark, "archive")
    lake = Lake(f"{root}/lake")
    for part in statement_parts(spark, sf_dir):
        write_statements(part, f"{root}/inbox")
        ingest_inbox(spark, f"{root}/inbox", lake, f"{root}/checkpoint", f"{root}/archive").awaitTermination()
    # Below the archive files keep their whole path.
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(f"{root}/archive")
    owner = F.regexp_extract(F.url_decode(F.col("_metadata.file_path")), r"/([^/]+)/[^/]+$", 1)
    archived = lines.where(~F.col("value").startswith("Date,")).groupBy(owner.alias("profile_id"), F.col("_metadata.file_name").alias("file")).count()
    known = read_table(spark, lake.registry, REGISTRY).select("profile_id", "file")
    return archived.join(known, ["profile_id", "file"], "left_semi").groupBy("profile_id").agg(F.sum("count").alias("rows"))


def export_spend_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _exports(spark, sf_dir)
    schema = "profile_id string, year int, month int, category string, subcategory string, spend double, profile string"
    return spark.read.schema(schema).option("header", True).csv(f"{out}/category_spend_only")


def taxonomy_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part types and brands as a taxonomy file whose descriptions hold unquoted commas."""
    path = shared_folder(spark, "taxonomy")
    kinds = table(spark, sf_dir, "part").select("p_type", "p_brand").distinct()
    lines = kinds.select(F.concat_ws(",", "p_type", "p_brand", F.format_string("%s parts, from %s", "p_type", "p_brand")).alias("value"))
    header = spark.sql("SELECT 'category,subcategory,description' AS value")
    header.unionByName(lines).write.text(path)
    return read_taxonomy(spark, path)


_MONTHLY_FROM_FACTS = f"""WITH {FACTS_SQL}, monthly AS (
  SELECT profile_id, year, month, category, subcategory, sum(amount) AS total_amount FROM facts GROUP BY ALL)"""

QUERIES = {
    "monthly_totals": (monthly_totals, MONTHLY_SQL),
    "standardize_silver": (
        standardize_silver,
        f"WITH {SILVER_SQL} SELECT profile_id, txn_id, account_id, post_date, CAST(amount AS DOUBLE) AS amount, currency,"
        " description, name, clean_desc, CAST(balance AS DOUBLE) AS balance, merchant, CAST(NULL AS VARCHAR) AS category,"
        " is_transfer, year, month FROM silver",
    ),
    "parse_mixed_dates": (parse_mixed_dates, _parse_mixed_dates_sql()),
    "signed_amount_debit_credit": (
        signed_amount_debit_credit,
        "SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'O' THEN l_extendedprice WHEN l_quantity = 1 THEN 0.0"
        " ELSE -l_extendedprice END AS amount FROM lineitem",
    ),
    "amounts_lossless": (
        amounts_lossless,
        """SELECT l_orderkey, l_linenumber, l_partkey, regexp_replace(CAST((l_orderkey * 1000003 + l_linenumber) * 98765 % 1000000000000000 AS VARCHAR) || '.' ||
         lpad(CAST(l_partkey * 79190 % 100000000 AS VARCHAR), 8, '0'), '(\\.\\d+?)0+$', '\\1') AS amount FROM lineitem""",
    ),
    "unread_amounts": (unread_amounts, UNREAD_SQL),
    "canonicalize_headers": (
        canonicalize_headers,
        """SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS post_date, l_returnflag AS description,
         l_extendedprice AS amount, NULL AS currency, CAST(l_suppkey AS VARCHAR) AS account_id,
         CAST(NULL AS DOUBLE) AS balance FROM lineitem
         UNION ALL SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR), o_orderpriority,
         CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END, 'EUR', CAST(o_custkey AS VARCHAR), NULL
         FROM orders UNION ALL SELECT NULL, c_name, 0.0, NULL, NULL, c_acctbal FROM customer""",
    ),
    "dedup_transactions": (dedup_transactions_query, DEDUP_SQL),
    "dedup_repeats": (dedup_repeats, REPEATS_SQL),
    "fact_transactions": (fact_query, f"WITH {FACTS_SQL} SELECT {FACT_COLUMNS_SQL} FROM facts"),
    "category_monthly": (
        category_monthly_query,
        _MONTHLY_FROM_FACTS + " SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount) FROM monthly",
    ),
    "spend_only": (
        spend_only_query,
        _MONTHLY_FROM_FACTS + " SELECT profile_id, year, month, category, subcategory,"
        " CAST(-total_amount AS DOUBLE) AS spend FROM monthly WHERE total_amount < 0",
    ),
    "file_registry_new": (file_registry_new, FILE_REGISTRY_SQL),
    "content_line_digest": (content_line_digest, LINE_DIGEST_SQL),
    "inbox_incremental": (inbox_incremental, INBOX_SQL),
    "lake_roundtrip": (
        lake_roundtrip,
        f"WITH {FACTS_SQL}, numbered AS (SELECT *, row_number() OVER (PARTITION BY txn_id ORDER BY description) AS n"
        f" FROM facts) SELECT {FACT_COLUMNS_SQL} FROM numbered WHERE n = 1",
    ),
    "lake_roundtrip_monthly": (lake_roundtrip_monthly, MONTHLY_SQL),
    "inbox_archive": (
        inbox_archive,
        f"WITH {LEDGER_SQL} SELECT 'owner=' || profile_id AS profile_id, count(*) AS rows FROM ledger WHERE amount < 0 GROUP BY 1",
    ),
    "export_roundtrip": (export_roundtrip, EXPORT_SQL),
    "export_monthly_roundtrip": (
        export_monthly_roundtrip,
        _MONTHLY_FROM_FACTS + " SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount), profile_id AS profile FROM monthly",
    ),
    "export_spend_roundtrip": (
        export_spend_roundtrip,
        _MONTHLY_FROM_FACTS + " SELECT profile_id, year, month, category, subcategory,"
        " CAST(-total_amount AS DOUBLE) AS spend, profile_id AS profile FROM monthly WHERE total_amount < 0",
    ),
    "taxonomy_dimension": (
        taxonomy_dimension,
        "SELECT DISTINCT p_type AS category, p_brand AS subcategory, p_type || ' parts, from ' || p_brand AS description"
        " FROM part",
    ),
}
