"""Order-insensitive comparison of a Spark result with a DuckDB oracle result.

Used by the tests and by ``scripts/check_oracle.py``; mirrors the driver's
check (column names, row count, value multiset).
"""
from __future__ import annotations

import datetime as _dt
import decimal
import math


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (_dt.datetime,)):
        return v.isoformat(sep=" ")
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "item"):  # numpy scalar
        return _norm(v.item())
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark_df, duck_conn, sql: str) -> dict:
    s_cols = list(spark_df.columns)
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = duck_conn.sql(sql)
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    res = {
        "cols_match": sorted(s_cols) == sorted(d_cols),
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
    }
    res["rows_match"] = res["spark_rows"] == res["oracle_rows"]
    if res["cols_match"]:
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        res["values_match"] = a == b
        if not res["values_match"]:
            sa, sb = set(a), set(b)
            res["only_spark"] = [x for x in a if x not in sb][:3]
            res["only_oracle"] = [x for x in b if x not in sa][:3]
    else:
        res["values_match"] = False
        res["spark_cols"], res["oracle_cols"] = s_cols, d_cols
    res["ok"] = res["cols_match"] and res["rows_match"] and res["values_match"]
    return res


def duck_connection(sf_dir: str, tables):
    import duckdb
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con
