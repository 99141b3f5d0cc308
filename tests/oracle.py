"""Compares a query with its SQL over the same tables in DuckDB."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    return con


def same(spark, sf_dir, query, sql):
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(*columns).collect()), key=repr)
    con = connect(sf_dir)
    assert sorted(con.sql(sql).columns) == columns
    want = sorted((tuple(map(plain, r)) for r in con.sql(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()), key=repr)
    assert got == want
