"""Run queries() against oracle_sql() on DuckDB and compare (like the driver).

Usage: python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v + 0.0)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def digest(cols: list[str], rows: list[tuple]) -> tuple[list[str], list[str]]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return [cols[i] for i in order], lines


def compare(spark, sf_dir: str, keys: list[str] | None = None, verbose: bool = True) -> dict[str, dict]:
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for k in keys or list(qs):
        res = {"key": k}
        t0 = time.time()
        try:
            df = qs[k](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
            res["spark_sec"] = round(time.time() - t0, 2)
        except Exception as e:  # noqa: BLE001
            res["status"] = f"SPARK_ERROR {type(e).__name__}: {str(e)[:300]}"
            out[k] = res
            if verbose:
                print(k, res["status"], flush=True)
            continue
        res["rows"] = len(srows)
        if k not in sqls:
            res["status"] = "ROWS_ONLY"
            out[k] = res
            if verbose:
                print(f"{k}: rows-only {len(srows)} rows ({res['spark_sec']}s)", flush=True)
            continue
        try:
            cur = con.execute(sqls[k])
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            res["status"] = f"ORACLE_ERROR {type(e).__name__}: {str(e)[:300]}"
            out[k] = res
            if verbose:
                print(k, res["status"], flush=True)
            continue
        sc, sl = digest(scols, srows)
        oc, ol = digest(ocols, orows)
        ok_cols = sc == oc
        ok_rows = len(sl) == len(ol)
        ok_vals = sl == ol
        res["status"] = "MATCH" if (ok_cols and ok_rows and ok_vals) else "MISMATCH"
        if res["status"] != "MATCH":
            res["detail"] = {"spark_cols": sc, "oracle_cols": oc, "spark_rows": len(sl), "oracle_rows": len(ol)}
            if ok_cols:
                a, b = set(sl), set(ol)
                res["detail"]["only_spark"] = sorted(a - b)[:3]
                res["detail"]["only_oracle"] = sorted(b - a)[:3]
        res["hash"] = hashlib.sha1("\n".join(sl).encode()).hexdigest()[:12]
        out[k] = res
        if verbose:
            print(f"{k}: {res['status']} rows={len(srows)} ({res['spark_sec']}s)"
                  + (f" {res.get('detail')}" if res["status"] != "MATCH" else ""), flush=True)
        if len(srows) == 0:
            print(f"  WARNING {k}: empty result", flush=True)
    return out


if __name__ == "__main__":
    from shoplake.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = build_session()
    r = compare(spark, sf, keys)
    bad = [k for k, v in r.items() if v["status"] not in ("MATCH", "ROWS_ONLY")]
    print("SUMMARY", len(r), "checked,", len(bad), "bad:", bad)
