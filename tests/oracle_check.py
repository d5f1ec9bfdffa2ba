"""Run registered queries in Spark and their oracle SQL in DuckDB on the same
driver tables; compare row count, column names and an order-insensitive value
hash (the same three checks the driver makes).

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(float(v))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, bool):
        return str(v)
    return str(v)


def value_hash(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def pandas_rows(pdf):
    """Rows of a pandas frame as plain Python values (NaN/NA -> None)."""
    import pandas as pd
    out = []
    for rec in pdf.itertuples(index=False, name=None):
        row = []
        for v in rec:
            if v is None or (not isinstance(v, (list, tuple)) and not hasattr(v, "tolist") and pd.isna(v)):
                row.append(None)
            elif hasattr(v, "item") and not hasattr(v, "__len__"):
                row.append(v.item())
            else:
                row.append(v)
        out.append(tuple(row))
    return out


def run(sf_dir, names=None, verbose=True, via_pandas=False):
    import duckdb

    from __spark_entry__ import oracle_sql, queries
    from featpipe.session import local_session
    from featpipe.sources.tables import TABLES

    spark = local_session(os.environ.get("ORACLE_CPUS", "8"),
                          shuffle_partitions=int(os.environ.get("ORACLE_SHUFFLE_PARTITIONS", "8")))
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, oracles = queries(), oracle_sql()
    report = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            s_cols = df.columns
            s_rows = pandas_rows(df.toPandas()) if via_pandas else [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            report[name] = {"ok": False, "error": f"spark: {type(e).__name__}: {str(e)[:400]}"}
            print(name, report[name]) if verbose else None
            continue
        ts = time.time() - t0
        if name not in oracles:
            report[name] = {"ok": None, "rows": len(s_rows), "spark_s": round(ts, 2)}
            print(name, report[name]) if verbose else None
            continue
        try:
            rel = con.sql(oracles[name])
            o_cols = rel.columns
            o_rows = pandas_rows(rel.df()) if via_pandas else rel.fetchall()
        except Exception as e:  # noqa: BLE001
            report[name] = {"ok": False, "error": f"duckdb: {type(e).__name__}: {str(e)[:400]}"}
            print(name, report[name]) if verbose else None
            continue
        hs, ls = value_hash(s_rows, s_cols)
        ho, lo = value_hash(o_rows, o_cols)
        ok = (len(s_rows) == len(o_rows)) and sorted(s_cols) == sorted(o_cols) and hs == ho
        rep = {"ok": ok, "rows": len(s_rows), "oracle_rows": len(o_rows), "spark_s": round(ts, 2)}
        if sorted(s_cols) != sorted(o_cols):
            rep["cols"] = [sorted(s_cols), sorted(o_cols)]
        if not ok and sorted(s_cols) == sorted(o_cols):
            a, b = set(ls), set(lo)
            rep["only_spark"] = sorted(a - b)[:3]
            rep["only_oracle"] = sorted(b - a)[:3]
        report[name] = rep
        print(name, json.dumps(rep, default=str)[:1500]) if verbose else None
    return report


if __name__ == "__main__":
    args = [a for a in sys.argv[1:] if a != "--pandas"]
    sf = args[0] if args else "/root/testdata/sf0.01"
    rep = run(sf, args[1:] or None, via_pandas="--pandas" in sys.argv)
    bad = [k for k, v in rep.items() if v.get("ok") is False]
    print("FAILED:", bad)
    print("passed", sum(1 for v in rep.values() if v.get("ok")), "of", len(rep))
