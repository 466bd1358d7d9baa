"""Run queries beside their SQL in DuckDB and compare names, rows and values."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def sql_rows(con, sql: str) -> tuple[list[str], Counter]:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(repr(row[i]) for i in order) for row in cur.fetchall())


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(repr(row[n]) for n in names) for row in df.select(*[f"`{n}`" for n in names]).collect())


def compare(df, con, sql: str) -> str:
    """Empty text where both agree, else what differs."""
    ours, theirs = spark_rows(df), sql_rows(con, sql)
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} / {theirs[0]}"
    if ours[1] != theirs[1]:
        extra, lost = ours[1] - theirs[1], theirs[1] - ours[1]
        return f"rows {sum(ours[1].values())} / {sum(theirs[1].values())}; only here {list(extra)[:2]}; only in SQL {list(lost)[:2]}"
    return "" if ours[1] else "both empty"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, checks = connect(folder), oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if wanted and name not in wanted:
            continue
        begun = time.time()
        try:
            df = fn(spark, folder)
            problem = compare(df, con, checks[name]) if name in checks else f"no SQL, {df.count()} rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        if problem or time.time() - begun > 3:
            print(f"{name:26s} {time.time() - begun:5.1f}s {problem or 'ok'}", flush=True)
    print("differing:", bad)
