"""Runs a query and its SQL over the same tables and compares the rows."""

import math

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    return round(float(value), 9) if isinstance(value, (int, float)) and not isinstance(value, bool) else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(_plain(r[i]) for i in order) for r in rows], key=repr)


def same(spark, sf_dir, query, sql):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    df = query(spark, sf_dir)
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, found.fetchall())
