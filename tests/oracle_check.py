"""Spark result vs DuckDB oracle, the way the driver compares them:
same row count, same column names, same multiset of values."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    con = duck(sf_dir)
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    res = {"query": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols), "spark_sec": round(t1 - t0, 2)}
    if not res["cols_match"]:
        res["spark_cols"], res["oracle_cols"] = s_cols, d_cols
        res["values_match"] = False
        return res
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    res["values_match"] = a == b
    if not res["values_match"]:
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        res["spark_only"], res["oracle_only"] = diff_a, diff_b
    return res


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from ledgerlens.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = get_session()
    qs, sqls = E.queries(), E.oracle_sql()
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            df = fn(spark, sf)
            print({"query": name, "rows_only": df.count()})
            continue
        print(compare(spark, name, fn, sqls[name], sf), flush=True)
