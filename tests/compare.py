"""Runs every query on Spark and its SQL on DuckDB and compares the rows, column by column.

    python -m tests.compare [folder of the tables] [query names ...]
"""

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from histload.plans.oracle import ORACLE_SQL
from histload.plans.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(normal(r[i]) for i in order) for r in rows)


def difference(spark, con, name, sf_dir):
    """Number of rows, and what differs (empty if nothing)."""
    df = QUERIES[name](spark, sf_dir)
    got_columns, got = rows_of(df.columns, df.collect())
    cursor = con.execute(ORACLE_SQL[name])
    columns, wanted = rows_of([c[0] for c in cursor.description], cursor.fetchall())
    if got_columns != columns:
        return len(got), f"columns {got_columns} / {columns}"
    if got != wanted:
        ours, theirs = set(got) - set(wanted), set(wanted) - set(got)
        return len(got), (
            f"{len(got)} / {len(wanted)} rows, only ours {list(ours)[:2]}, "
            f"only theirs {list(theirs)[:2]}"
        )
    return len(got), ""


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            n, wrong = difference(spark, con, name, sf_dir)
        except Exception as error:
            n, wrong = 0, f"{type(error).__name__} {str(error)[:600]}"
        print(f"{name:28s} {n:7d} rows {time.time() - start:6.2f} s  {wrong or 'same'}", flush=True)


if __name__ == "__main__":
    main()
