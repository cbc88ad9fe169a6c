"""Compare every witness with its DuckDB oracle (row count, schema, values).

    python -m tests.oracle_check [--sf /root/testdata/sf0.01] [key-prefix ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import sys
import time

import duckdb

SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE",
    "smallint": "SMALLINT", "tinyint": "TINYINT", "float": "FLOAT", "date": "DATE", "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def _norm(x):
    if x is None:
        return None
    if isinstance(x, float):
        if math.isnan(x):
            return None
        return round(x, 6)
    if isinstance(x, decimal.Decimal):
        return round(float(x), 6)
    if isinstance(x, (dt.datetime, dt.date)):
        return x.isoformat(sep=" ") if isinstance(x, dt.datetime) else x.isoformat()
    if hasattr(x, "item"):
        return _norm(x.item())
    if isinstance(x, (list, tuple)):
        return tuple(_norm(i) for i in x)
    return x


def _key(row):
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def duck_connection(sf_dir: str):
    from strandline.sources.tables import BASE_TABLES

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, key: str, sf_dir: str, builder, sql: str | None) -> dict:
    t0 = time.time()
    df = builder(spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    loops = [t for t in ("CartesianProduct", "BroadcastNestedLoopJoin") if t in plan]
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    stypes = [SPARK_TO_DUCK.get(t, t.upper()) for _, t in df.dtypes]
    t_spark = time.time() - t0
    res = {"key": key, "rows": len(srows), "spark_sec": round(t_spark, 2)}
    if loops:
        res["nested_loop_joins"] = loops
    if sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    dtypes = [str(d[1]) for d in cur.description]
    drows = cur.fetchall()
    problems = []
    if sorted(scols) != sorted(dcols):
        problems.append(f"columns spark={scols} duck={dcols}")
    else:
        smap = dict(zip(scols, stypes))
        dmap = dict(zip(dcols, dtypes))
        bad = {c: (smap[c], dmap[c]) for c in scols if smap[c] != dmap[c]}
        if bad:
            problems.append(f"types {bad}")
        order = sorted(scols)
        si = [scols.index(c) for c in order]
        di = [dcols.index(c) for c in order]
        s = sorted((tuple(_norm(r[i]) for i in si) for r in srows), key=_key)
        d = sorted((tuple(_norm(r[i]) for i in di) for r in drows), key=_key)
        if len(s) != len(d):
            problems.append(f"rowcount spark={len(s)} duck={len(d)}")
        if s != d:
            sset, dset = set(s), set(d)
            problems.append(f"values: spark-only {list(sset - dset)[:3]} duck-only {list(dset - sset)[:3]}")
    res["status"] = "ok" if not problems else "MISMATCH"
    if problems:
        res["problems"] = problems
    return res


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("prefixes", nargs="*")
    a = ap.parse_args(argv)
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from strandline.session import get_session

    spark = get_session()
    con = duck_connection(a.sf)
    q, o = queries(), oracle_sql()
    keys = [k for k in q if not a.prefixes or any(k.startswith(p) for p in a.prefixes)]
    n_ok = 0
    for k in keys:
        try:
            r = compare(spark, con, k, a.sf, q[k], o.get(k))
        except Exception as e:  # report and continue
            r = {"key": k, "status": "ERROR", "problems": [repr(e)[:600]]}
        n_ok += r["status"] in ("ok", "rows-only")
        print(r, flush=True)
    print(f"{n_ok}/{len(keys)} passing")


if __name__ == "__main__":
    main()
