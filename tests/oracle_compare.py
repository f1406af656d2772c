"""Run registered queries with Spark and their oracle SQL with DuckDB; compare.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def duck_connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as entry

    queries, oracles = entry.queries(), entry.oracle_sql()
    con = duck_connect(sf_dir)
    results = {}
    for name in names or list(queries):
        t0 = time.time()
        df = queries[name](spark, sf_dir)
        got_cols = df.columns
        got = [tuple(r) for r in df.collect()]
        secs = time.time() - t0
        if name not in oracles:
            results[name] = ("no-oracle", len(got), secs)
            continue
        cur = con.execute(oracles[name])
        want_cols = [d[0] for d in cur.description]
        want = cur.fetchall()
        ok_cols = sorted(got_cols) == sorted(want_cols)
        same = ok_cols and _rows(got_cols, got) == _rows(want_cols, want)
        results[name] = ("ok" if same else "MISMATCH", len(got), len(want), round(secs, 2))
        if verbose:
            print(name, results[name], "" if ok_cols else f"cols {got_cols} vs {want_cols}", flush=True)
            if not same and ok_cols:
                a, b = _rows(got_cols, got), _rows(want_cols, want)
                diff_a = [r for r in a if r not in set(b)][:3]
                diff_b = [r for r in b if r not in set(a)][:3]
                print("   spark-only:", diff_a, "\n   oracle-only:", diff_b)
    return results


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v[0] == "MISMATCH"]
    print("mismatches:", bad)
