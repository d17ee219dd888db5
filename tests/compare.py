"""Compare a query with its SQL run by DuckDB on the same tables."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir: str):
    found = duckdb.connect()
    for name in TABLES:
        found.sql(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return found


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return round(float(value), 7) + 0.0
    return value


def same(df, sql: str, sf_dir: str) -> None:
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)
    relation = connection(sf_dir).sql(sql)
    assert names == sorted(relation.columns)
    at = [relation.columns.index(n) for n in names]
    want = sorted((tuple(plain(r[i]) for i in at) for r in relation.fetchall()), key=repr)
    assert len(got) == len(want)
    assert got == want
