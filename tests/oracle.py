"""A query against its SQL in DuckDB."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if isinstance(x, float) and math.isnan(x):
        return None
    return round(x, 6) if isinstance(x, float) else x


def check(spark, sf, name, query, sql):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = query(spark, sf)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    res = con.sql(sql)
    assert sorted(res.columns) == cols, name
    want = sorted((tuple(plain(x) for x in r) for r in res.select(*[f'"{c}"' for c in cols]).fetchall()), key=repr)
    assert len(got) == len(want), (name, len(got), len(want))
    assert got == want, (name, [x for x in zip(got, want) if x[0] != x[1]][:3])
    return len(got)
