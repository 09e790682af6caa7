"""Runs a query and its SQL and compares names, row counts and values, whatever the row order."""

import glob
import math
import os

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def table_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cells = (tuple(plain(row[i]) for i in order) for row in rows)
    return sorted(names), sorted(cells, key=repr)


def spark_table(df):
    return table_of(df.columns, df.collect())


def sql_table(con, sql):
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    return table_of(names, result.fetchall())
