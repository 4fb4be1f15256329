"""Compare a query's rows with those of its SQL in DuckDB."""

import glob
import math
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool) or not isinstance(v, (int, float)):
        return str(v)
    return int(v) if float(v).is_integer() else float(v)


def rows(names, data):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(repr([_plain(r[i]) for i in order]) for r in data)


def compare(spark, con, query, sql, sf_dir):
    df = query(spark, sf_dir)
    got = con.sql(sql)
    assert sorted(df.columns) == sorted(got.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(got.columns, got.fetchall())
