"""Compare a registered query with its oracle SQL on a driver folder."""

import datetime as dt
import math
import os

import duckdb

import __spark_entry__ as E

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf_dir, t + '.parquet')}')")
    return con


def norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 9)  # NaN is not null
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def rows_of(df) -> list[tuple]:
    order = sorted(df.columns)
    return sorted((tuple(norm(r[c]) for c in order) for r in df.collect()), key=repr)


def oracle_rows(sf_dir: str, name: str) -> tuple[list[str], list[tuple]]:
    res = connect(sf_dir).execute(E.oracle_sql()[name])
    names = [d[0] for d in res.description]
    order = sorted(names)
    at = [names.index(c) for c in order]
    return order, sorted((tuple(norm(r[i]) for i in at) for r in res.fetchall()), key=repr)


def assert_matches_oracle(spark, sf_dir: str, name: str, df=None) -> None:
    df = E.queries()[name](spark, sf_dir) if df is None else df
    columns, rows = oracle_rows(sf_dir, name)
    assert sorted(df.columns) == columns, name
    assert rows_of(df) == rows, name
