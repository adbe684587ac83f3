"""Compare a Spark query with its DuckDB oracle: row count, column names and an
order-insensitive hash of the values (columns sorted by name)."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck_connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.10g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.10g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bool):
        return bool(v)
    return v


def table_digest(columns: list[str], rows: list[tuple]) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    normed = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    h = hashlib.sha256()
    for r in normed:
        h.update(repr(r).encode())
    return len(rows), sorted(columns), h.hexdigest()


def spark_digest(df):
    rows = [tuple(r) for r in df.collect()]
    return table_digest(df.columns, rows)


def duck_digest(con, sql: str):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return table_digest(cols, cur.fetchall())


def compare(spark, con, name: str, query, sql: str | None, sf_dir: str) -> dict:
    s = spark_digest(query(spark, sf_dir))
    out = {"name": name, "rows": s[0], "columns": s[1]}
    if sql is None:
        out["status"] = "rows-only"
        return out
    d = duck_digest(con, sql)
    out["oracle_rows"] = d[0]
    out["rows_match"] = s[0] == d[0]
    out["schema_match"] = s[1] == d[1]
    out["hash_match"] = s[2] == d[2]
    if s[1] != d[1]:
        out["oracle_columns"] = d[1]
    out["status"] = "ok" if (s[0] == d[0] and s[1] == d[1] and s[2] == d[2]) else "MISMATCH"
    return out
