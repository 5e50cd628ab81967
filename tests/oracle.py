"""Run registered queries next to their SQL twins: ``python tests/oracle.py [sf] [names…]``."""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from read_parquet('{root}/{t}.parquet')")
    return con


def normal(value):
    if value is None or value != value:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat(" ")
    if isinstance(value, decimal.Decimal):
        return f"{float(value):.6f}"
    if isinstance(value, float):
        return f"{value + 0.0:.6f}"
    return str(value)


def compare(df, con, sql: str) -> str:
    """Empty when schema names, row counts and sorted values agree; otherwise the first difference."""
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    theirs = rel.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))}"
    order = sorted(names)
    mine = sorted(tuple(normal(r[c]) for c in order) for r in df.collect())
    pick = [names.index(c) for c in order]
    other = sorted(tuple(normal(r[i]) for i in pick) for r in theirs)
    if len(mine) != len(other):
        return f"rows {len(mine)} != {len(other)}"
    for a, b in zip(mine, other):
        if a != b:
            return f"{dict(zip(order, a))} != {dict(zip(order, b))}"
    return "" if mine else "empty result"


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    import __spark_entry__ as entry

    sf, only = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    root = f"/root/testdata/sf{sf}"
    spark, con, sqls = session(), connect(root), entry.oracle_sql()
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = query(spark, root)
            if name in sqls:
                verdict = compare(df, con, sqls[name]) or f"ok {df.count()} rows"
            else:
                verdict = f"rows only: {df.count()}"
        except Exception as error:  # report and go on with the next query
            verdict = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:32s} {time.time() - start:6.1f}s  {verdict}", flush=True)
