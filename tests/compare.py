"""Run registered queries on Spark and their check SQL on DuckDB, and compare the results."""

from __future__ import annotations

import datetime as dt
import glob
import os
from collections import Counter

import duckdb
from pyspark.sql import SparkSession


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.isoformat(" ")
    return value


def multiset(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(_plain(row[i])) for i in order) for row in rows)


def differences(spark: SparkSession, con: duckdb.DuckDBPyConnection, query, sql: str,
                sf_dir: str) -> list[str]:
    df = query(spark, sf_dir)
    got = multiset(df.columns, df.collect())
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    want = multiset(columns, cursor.fetchall())
    problems = []
    if sorted(columns) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} against {sorted(columns)}")
    if not want:
        problems.append("no rows")
    if got != want:
        problems.append(f"{got.total()} rows against {want.total()}; "
                        f"only Spark {list((got - want).items())[:2]}; "
                        f"only SQL {list((want - got).items())[:2]}")
    return problems
