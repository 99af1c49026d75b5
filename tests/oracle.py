"""A query's rows against its SQL in DuckDB, in any order."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def run_sql(sql, sf):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    return names, cursor.fetchall()


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    one = lambda v: "null" if v is None or (isinstance(v, float) and math.isnan(v)) else f"{float(v):.6g}" if isinstance(v, float) else str(v)
    return sorted(tuple(one(r[i]) for i in order) for r in rows)


def same(df, sql, sf):
    names, rows = run_sql(sql, sf)
    assert sorted(df.columns) == sorted(names)
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(names, rows)
