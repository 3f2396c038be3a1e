"""Compares a query with its SQL, apart from the order of rows and columns."""

import math
import os

import duckdb


def connection(folder):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for name in os.listdir(folder):
        con.execute(f"create view \"{name[:-8]}\" as select * from '{folder}/{name}'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0)
    if isinstance(v, (list, tuple)):
        return repr([plain(x) for x in v])
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def check(query, sql, spark, folder, con):
    df = query(spark, folder)
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, found.fetchall())
