"""Run a query and its SQL equivalent and compare all rows, order aside."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os

import duckdb


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return sorted(df.columns), sorted_rows(df.columns, df.collect())


def duck_rows(sf, sql):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).split(".")[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), sorted_rows(columns, result.fetchall())


def duck_types(sf, sql):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).split(".")[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
