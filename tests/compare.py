"""Order-insensitive comparison of a Spark result with DuckDB's."""

import datetime
import decimal
import math
import os
from collections import Counter

import duckdb


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


def duck(sf_dir):
    c = duckdb.connect()
    for f in os.listdir(sf_dir):
        c.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf_dir}/{f}'")
    return c


def assert_same(df, relation):
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    at = [relation.columns.index(c) for c in columns]
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    want = Counter(tuple(plain(r[i]) for i in at) for r in relation.fetchall())
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])
