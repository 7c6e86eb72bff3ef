"""Compares a Spark query with its DuckDB SQL: columns by name, rows in any order."""

import glob
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir):
    c = duckdb.connect()
    c.sql("set timezone = 'UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            c.sql(f"create view {t} as select * from read_parquet('{p if os.path.isfile(p) else p + '/*.parquet'}')")
    return c


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else float(f"{x:.9g}")
    return x


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in values), key=repr)


def compare(spark, sf_dir, query, sql):
    df = query(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    rel = connection(sf_dir).sql(sql)
    want = rows(rel.columns, rel.fetchall())
    assert sorted(df.columns) == sorted(rel.columns), (sorted(df.columns), sorted(rel.columns))
    assert len(got) == len(want), (len(got), len(want))
    for a, b in zip(got, want, strict=True):
        assert a == b, (a, b)
    return len(got)
