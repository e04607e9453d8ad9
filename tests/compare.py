"""Runs the registered queries against their SQL in DuckDB."""

import datetime
import decimal
import glob
import math
import os

import duckdb


def connection(sf_dir):
    con = duckdb.connect()
    for p in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(p).split(".")[0]
        con.sql(f"create view {name} as select * from '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (decimal.Decimal, int)):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return f"{v.isoformat()}T00:00:00" if False else v.isoformat()
    return v


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, f, sql, sf_dir):
    df = f(spark, sf_dir)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    want = table(rel.columns, rel.fetchall())
    return got, want
