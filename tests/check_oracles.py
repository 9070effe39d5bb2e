"""Runs registered queries against their SQL: python tests/check_oracles.py <sf_dir> [name prefix ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name, build, sql, sf_dir):
    df = build(spark, sf_dir)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_cols, want = rows_of([c[0] for c in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}", len(got)
    if got != want:
        gs, ws = set(got), set(want)
        return f"rows {len(got)} vs {len(want)}; only spark {sorted(gs - ws)[:3]}; only sql {sorted(ws - gs)[:3]}", len(got)
    return None, len(got)


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    sf_dir, prefixes = sys.argv[1], tuple(sys.argv[2:])
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracle, bad = e.oracle_sql(), 0
    for name, build in e.queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        t = time.time()
        try:
            if name in oracle:
                problem, n = compare(spark, con, name, build, oracle[name], sf_dir)
            else:
                problem, n = None, build(spark, sf_dir).count()
        except Exception as x:  # noqa: BLE001
            problem, n = f"{type(x).__name__}: {str(x)[:600]}", 0
        bad += problem is not None
        kind = "ok  " if problem is None else "FAIL"
        print(f"{kind} {name} rows={n} {time.time() - t:.1f}s{'' if name in oracle else ' (rows only)'} {problem or ''}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
