"""Spark results against DuckDB on the same tables, as multisets of rows."""

from __future__ import annotations

import datetime
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows(columns: list[str], found) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in found)


def differences(spark, con, sf_dir: str, query, sql: str) -> str | None:
    frame = query(spark, sf_dir)
    mine = rows(frame.columns, frame.collect())
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    theirs = rows(columns, cursor.fetchall())
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(frame.columns)} / {sorted(columns)}"
    if mine != theirs:
        extra = list((mine - theirs).items())[:3]
        lacking = list((theirs - mine).items())[:3]
        return (
            f"{sum(mine.values())} / {sum(theirs.values())} rows; "
            f"only Spark {extra}; only SQL {lacking}"
        )
    return None if mine else "no rows"
