"""Compare registered queries with their SQL in DuckDB."""

from __future__ import annotations

import datetime
import decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, decimal.Decimal):
        v = int(v) if v == int(v) else float(v)
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return repr(v + 0.0)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return str(v)


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(_cell(r[c]) for c in cols) for r in df.collect())


def rows_of_duck(con, sql: str):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(_cell(r[i]) for i in order) for r in rel.fetchall()]
    return [names[i] for i in order], sorted(rows)


def types_of_duck(con, sql: str):
    rel = con.execute(sql)
    return {d[0]: str(d[1]) for d in rel.description}
