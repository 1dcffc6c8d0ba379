"""Compare registered queries with their SQL twins in DuckDB."""

from __future__ import annotations

import datetime
import math
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, bytearray):
        return bytes(v)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(norm(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> tuple[int, list[str]]:
    """Row count and a list of complaints."""
    got_names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_names, want = rows_of([c[0] for c in cur.description], cur.fetchall())
    issues = []
    if got_names != want_names:
        issues.append(f"columns {got_names} vs {want_names}")
    elif got != want:
        issues.append(
            f"rows {sum(got.values())} vs {sum(want.values())}; "
            f"spark only {list((got - want).items())[:3]}; sql only {list((want - got).items())[:3]}"
        )
    return sum(got.values()), issues
