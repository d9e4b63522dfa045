"""Runs a query and its SQL on the same tables and compares rows, names and integer types."""

import os

import duckdb

DATA = "/root/testdata/sf0.001"


def connection(folder=DATA):
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for f in os.listdir(folder):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{folder}/{f}{'/*.parquet' if os.path.isdir(f'{folder}/{f}') else ''}'")
    return c


def compare(spark, con, query, sql, folder=DATA):
    df = query(spark, folder)
    columns = sorted(df.columns)
    mine = [tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    result = con.execute(sql)
    names = [x[0] for x in result.description]
    order = [names.index(c) for c in columns] if sorted(names) == columns else None
    assert order is not None, (columns, sorted(names))
    theirs = [tuple(r[i] for i in order) for r in result.fetchall()]
    key = lambda t: tuple((x is not None, str(x)) for x in t)
    assert sorted(mine, key=key) == sorted(theirs, key=key)
