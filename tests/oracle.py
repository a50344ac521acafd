"""Compare a Spark result with DuckDB's, column by name and row by row."""

import math
from collections import Counter
from datetime import datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value.isoformat() if isinstance(value, datetime) else value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def assert_same(df, db, sql):
    result = db.execute(sql)
    expected_names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(expected_names)
    got = rows_of(df.columns, df.collect())
    expected = rows_of(expected_names, result.fetchall())
    assert sum(got.values()) == sum(expected.values())
    assert got == expected, (list((got - expected))[:3], list((expected - got))[:3])
