"""Order-insensitive comparison of a Spark result with its DuckDB oracle
(the check the driver runs: row count, column names, value multiset)."""

from __future__ import annotations

import datetime as dt
import decimal
import math

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duckdb_for(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def canonical(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else a short description of the difference."""
    scols, srows = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    dcols, drows = [d[0] for d in res.description], res.fetchall()
    if sorted(scols) != sorted(dcols):
        return f"columns {sorted(scols)} vs {sorted(dcols)}"
    a, b = canonical(scols, srows), canonical(dcols, drows)
    if a != b:
        sa, sb = set(a), set(b)
        return (f"rows {len(a)} vs {len(b)}; spark-only {[r for r in a if r not in sb][:2]}; "
                f"oracle-only {[r for r in b if r not in sa][:2]}")
    return None
