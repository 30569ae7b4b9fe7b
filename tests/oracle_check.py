"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: python -m tests.oracle_check /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        if v.is_integer() and abs(v) < 2**53:
            return str(int(v))
        return repr(round(v, 9))
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_canon(x) for x in v) + "]"
    if hasattr(v, "tolist"):
        return _canon(v.tolist())
    try:
        if pd.isna(v):
            return "NULL"
    except (TypeError, ValueError):
        pass
    if isinstance(v, bool):
        return str(v)
    return str(v)


def _kind(dtype) -> str:
    s = str(dtype).lower()
    if "datetime" in s:
        return "ts"
    if "bool" in s:
        return "bool"
    if "int" in s:
        return "int"
    if "float" in s:
        return "float"
    return "obj"


def rows(pdf: pd.DataFrame) -> tuple[list[str], Counter]:
    cols = sorted(pdf.columns)
    pdf = pdf[cols]
    c = Counter()
    for rec in pdf.itertuples(index=False, name=None):
        c["|".join(_canon(v) for v in rec)] += 1
    return cols, c


def compare(spark, sf_dir: str, key: str, con=None) -> dict:
    from __spark_entry__ import oracle_sql, queries
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = queries()[key](spark, sf_dir).toPandas()
    t1 = time.time()
    sql = oracle_sql().get(key)
    res = {"key": key, "spark_rows": len(sdf), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    odf = con.execute(sql).fetchdf()
    res["oracle_rows"] = len(odf)
    sc, srows = rows(sdf)
    oc, orows = rows(odf)
    kinds_s = {c: _kind(sdf[c].dtype) for c in sdf.columns}
    kinds_o = {c: _kind(odf[c].dtype) for c in odf.columns}
    if sc != oc:
        res["status"] = f"columns differ: spark-only {set(sc) - set(oc)} oracle-only {set(oc) - set(sc)}"
    elif srows != orows:
        diff_s = list((srows - orows).elements())[:3]
        diff_o = list((orows - srows).elements())[:3]
        res["status"] = f"values differ\n  spark: {diff_s}\n  oracle: {diff_o}"
    else:
        bad = {c: (kinds_s[c], kinds_o[c]) for c in sc if kinds_s[c] != kinds_o[c]
               and not (len(sdf) == 0)}
        res["status"] = "ok" if not bad else f"ok-values, type kinds differ {bad}"
    return res


def main(argv: list[str]) -> int:
    from histlake.session import build_session
    from __spark_entry__ import queries
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:] or sorted(queries())
    spark = build_session()
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, sf_dir, k, con)
        except Exception as e:  # report and continue
            r = {"key": k, "status": f"error {type(e).__name__}: {str(e)[:400]}"}
        ok = str(r["status"]).startswith("ok") or r["status"] == "rows-only"
        bad += 0 if ok else 1
        print(("PASS " if ok else "FAIL ") + str(r), flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
