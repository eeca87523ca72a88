"""Compare a named query with its SQL twin run by DuckDB on the same files."""

import datetime
import decimal
import glob
import math
import os

import duckdb


def connect(folder):
    db = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        db.execute(f"create view {name} as select * from '{path}'")
    return db


def plain(value):
    if value is None or isinstance(value, (str, bool)):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, int):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def difference(spark, folder, query):
    """None when equal, else a short description."""
    df = query.run(spark, folder)
    got = rows_of(df.columns, df.collect())
    cursor = connect(folder).execute(query.sql)
    columns = [c[0] for c in cursor.description]
    want = rows_of(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows: {got[:2]} ... {want[:2]}"
    for a, b in zip(got, want):
        if a != b:
            return f"first difference: {str(a)[:700]} != {str(b)[:700]}"
    return None
