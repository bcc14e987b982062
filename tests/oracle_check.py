"""Run registered queries on Spark and their DuckDB oracle SQL; compare
row count, column names and order-insensitive values (the driver's check)."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
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
            return None
        return round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return v


def rows_of(records, cols):
    out = []
    for r in records:
        out.append(tuple(_norm(r[c]) for c in cols))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sorted(sdf.columns)
    srows = [r.asDict() for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = [dict(zip(dcols, r)) for r in res.fetchall()]
    t2 = time.time()
    if sorted(dcols) != scols:
        return False, f"columns differ spark={scols} duck={sorted(dcols)}", t1 - t0, t2 - t1
    if len(srows) != len(drows):
        return False, f"rows differ spark={len(srows)} duck={len(drows)}", t1 - t0, t2 - t1
    a, b = rows_of(srows, scols), rows_of(drows, scols)
    for x, y in zip(a, b):
        if x != y:
            diff = [(c, p, q) for c, p, q in zip(scols, x, y) if p != q]
            return False, f"value diff {str(diff)[:600]}", t1 - t0, t2 - t1
    return True, f"{len(srows)} rows", t1 - t0, t2 - t1


def main(argv):
    sys.path.insert(0, "/root/repo")
    from riskfeed.session import local_session
    import __spark_entry__ as E
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            print(f"--   {name:26s} (no oracle)", flush=True)
            continue
        try:
            ok, msg, ts, td = compare(spark, con, name, fn, sqls[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, msg, ts, td = False, f"error {str(e)[:800]}", 0, 0
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'}  {name:26s} {msg}  spark={ts:.1f}s duck={td:.1f}s", flush=True)
    print("mismatches:", bad)


if __name__ == "__main__":
    main(sys.argv)
