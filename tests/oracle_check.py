"""Run registered queries in Spark and their oracle SQL in DuckDB; compare
row count, column names and an order-insensitive multiset of rows."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "isoformat") and not isinstance(v, str):
        try:
            v = v.replace(tzinfo=None)
        except TypeError:
            pass
        return v.isoformat()
    if hasattr(v, "as_tuple"):  # Decimal
        return float(v)
    if isinstance(v, bool):
        return int(v)
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(repr(_norm(r[i])) for i in order) for r in records]
    out.sort()
    return [cols[i] for i in order], out


def compare(spark, name, fn, sql, root, con):
    t = time.time()
    sdf = fn(spark, root)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    st = time.time() - t
    if sql is None:
        return dict(name=name, ok=None, spark_rows=len(srows), spark_s=round(st, 2))
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    sc, sr = rows_of(scols, srows)
    dc, dr = rows_of(dcols, drows)
    res = dict(name=name, spark_rows=len(sr), duck_rows=len(dr), cols_ok=sc == dc, spark_s=round(st, 2))
    res["ok"] = sc == dc and sr == dr
    if not res["ok"]:
        if sc != dc:
            res["cols"] = (sc, dc)
        else:
            a, b = set(sr), set(dr)
            res["only_spark"] = list(a - b)[:3]
            res["only_duck"] = list(b - a)[:3]
    return res


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from velotide.registry import ORACLE, QUERIES
    from velotide.session import get_session
    root = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(root)
    bad = 0
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        try:
            r = compare(spark, name, fn, ORACLE.get(name), root, con)
        except Exception as e:  # report and continue
            r = dict(name=name, ok=False, error=repr(e)[:600])
        bad += r.get("ok") is False
        print(r, flush=True)
    print("FAILED", bad)
