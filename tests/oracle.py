"""Holds a query's rows against its SQL in DuckDB."""

from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows_of(df):
    cols = sorted(df.columns)
    return cols, Counter(tuple(repr(r[c]) for c in cols) for r in df.collect())


def rows_of_sql(sql, folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    cols = sorted(names)
    at = [names.index(c) for c in cols]
    return cols, Counter(tuple(repr(r[i]) for i in at) for r in cur.fetchall())


def check(spark, folder, query, sql):
    cols, got = rows_of(query(spark, folder))
    sql_cols, expected = rows_of_sql(sql, folder)
    assert cols == sql_cols
    assert got == expected, (list((got - expected).items())[:3], list((expected - got).items())[:3])
