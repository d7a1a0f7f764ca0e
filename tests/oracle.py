"""Compare registered queries with DuckDB. As a script: python tests/oracle.py [sf_dir] [name ...]"""

from __future__ import annotations

import datetime
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, datetime.datetime) and v.time() == datetime.time():
        return v.date()
    return v


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cells = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(cells, key=repr)


def compare(spark, con, run, sql, sf_dir) -> str | None:
    """None if Spark and DuckDB agree in columns and rows, else what differs."""
    df = run(spark, sf_dir)
    names, rows = _sorted(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    sql_names, sql_rows = _sorted([d[0] for d in res.description], res.fetchall())
    if names != sql_names:
        return f"columns {names} != {sql_names}"
    if len(rows) != len(sql_rows):
        return f"{len(rows)} rows != {len(sql_rows)}"
    wrong = [(a, b) for a, b in zip(rows, sql_rows) if a != b]
    return f"{len(wrong)} of {len(rows)} rows differ, first: {wrong[0]}" if wrong else None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    from tallybook.plans.catalog import CATALOG

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name, (run, sql) in CATALOG.items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            problem = compare(session, con, run, sql, sf)
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failed:", bad)
