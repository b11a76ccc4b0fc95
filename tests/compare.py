"""Rows of a query against rows of its SQL, in any order."""

import datetime
import decimal
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(folder):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        if os.path.exists(path):
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return db


def plain(v):
    if isinstance(v, float):
        return round(v, 6) if math.isfinite(v) else str(v)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize() + 0)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def assert_equal(df, db, sql):
    found = db.execute(sql)
    names = sorted(c[0] for c in found.description)
    assert sorted(df.columns) == names
    at = [[c[0] for c in found.description].index(n) for n in names]
    want = sorted(repr(tuple(plain(r[i]) for i in at)) for r in found.fetchall())
    have = sorted(repr(tuple(plain(r[n]) for n in names)) for r in df.collect())
    assert have == want
