"""Runs a query and its SQL over the same tables."""

import glob
import os

import duckdb

SMALL = "/root/testdata/sf0.001"


def shown(v):
    return "" if v is None else repr(round(v, 6) + 0.0) if isinstance(v, float) else str(v)


def views(sf_dir):
    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return con


def same(spark, con, query, sql, sf_dir=SMALL):
    df = query(spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted(tuple(map(shown, r)) for r in df.select(*cols).collect())
    rel = con.execute(sql)
    names = [c[0] for c in rel.description]
    assert sorted(names) == cols
    want = sorted(tuple(shown(r[names.index(c)]) for c in cols) for r in rel.fetchall())
    assert got == want
