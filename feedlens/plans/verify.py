"""Compare a registered query against its DuckDB oracle (row count, column
names, order-insensitive values). Used by tests and by ``check_oracle.py``."""

from __future__ import annotations

import datetime as _dt
import math

from feedlens.sources.tables import TABLES


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, _dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from feedlens.plans.registry import oracle_sql, queries
    q = queries()[name]
    sql = oracle_sql().get(name)
    df = q(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    res = {"name": name, "spark_rows": len(s_rows), "columns": s_cols}
    if sql is None:
        res["status"] = "rows-only"
        return res
    con = con or duck_connect(sf_dir)
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    res["oracle_rows"] = len(d_rows)
    res["oracle_columns"] = d_cols
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = "schema-mismatch"
        return res
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_index = {c: i for i, c in enumerate(d_cols)}
    sn = sorted((tuple(_norm(r[i]) for i in order) for r in s_rows), key=_key)
    dn = sorted((tuple(_norm(r[d_index[s_cols[i]]]) for i in order) for r in d_rows), key=_key)
    if len(sn) != len(dn):
        res["status"] = "count-mismatch"
    elif sn != dn:
        res["status"] = "value-mismatch"
        diff = [(a, b) for a, b in zip(sn, dn) if a != b][:3]
        res["diff"] = diff
    else:
        res["status"] = "match"
    return res
