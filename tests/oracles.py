"""Runs registered queries beside their SQL on the smallest tables."""

import datetime
import decimal
import math
from pathlib import Path

import duckdb

SMALL = "/root/testdata/sf0.001"


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, decimal.Decimal):
        return round(float(value), 6)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def connect(folder=SMALL):
    db = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        db.sql(f"create view {file.stem} as select * from '{file}'")
    return db


def compare(spark, query, sql, folder=SMALL):
    frame, answer = query(spark, folder), connect(folder).sql(sql)
    columns = sorted(frame.columns)
    assert columns == sorted(answer.columns)
    order = [answer.columns.index(c) for c in columns]
    ours = sorted(repr(tuple(plain(row[c]) for c in columns)) for row in frame.collect())
    theirs = sorted(repr(tuple(plain(row[i]) for i in order)) for row in answer.fetchall())
    assert ours == theirs
