"""Rows of a query and of its SQL, in comparable form."""

import glob
import math
import os

import duckdb

SF = "/root/testdata/sf0.001"


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(norm, v)) + "]"
    return repr(v)


def of_sql(sql, sf=SF):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    r = con.execute(sql)
    names = [d[0] for d in r.description]
    cols = sorted(names)
    at = [names.index(c) for c in cols]
    return cols, sorted(tuple(norm(x[i]) for i in at) for x in r.fetchall())


def of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
