"""Run a query and its SQL counterpart and compare them as bags of rows."""

import math

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return repr(value + 0.0)
    if hasattr(value, "to_pydatetime"):
        value = value.to_pydatetime()
    return str(value)


def bag(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(_plain(r[i])) for i in order) for r in rows)


def compare(df, con, sql):
    """An empty text when equal, else a description of the first difference."""
    cursor = con.execute(sql)
    want_columns = [d[0] for d in cursor.description]
    want = bag(cursor.fetchall(), want_columns)
    got = bag([tuple(r) for r in df.collect()], df.columns)
    if sorted(want_columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(want_columns)}"
    if len(want) != len(got):
        return f"rows {len(got)} != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{sorted(df.columns)}\n got {g}\nwant {w}"
    return ""
