"""Run registered queries on Spark and DuckDB and compare them.

    python check.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time

import duckdb

from furrow.plans.queries import all_queries
from furrow.session import build_session, run_folder

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def oracle(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    fix = lambda v: round(v, 9) if isinstance(v, float) else v
    return sorted(columns), sorted((tuple(fix(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, plan, statement, sf_dir):
    started = time.time()
    df = plan(spark, sf_dir)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - started
    if statement is None:
        return f"rows {len(got[1])}", took, 0.0, True
    started = time.time()
    cur = con.execute(statement)
    want = canonical([d[0] for d in cur.description], cur.fetchall())
    sql_took = time.time() - started
    if got == want:
        return f"equal {len(got[1])}", took, sql_took, True
    if got[0] != want[0]:
        return f"COLUMNS {got[0]} / {want[0]}", took, sql_took, False
    a, b = set(map(repr, got[1])), set(map(repr, want[1]))
    sample = f"\n   spark only {sorted(a - b)[:2]}\n   sql only   {sorted(b - a)[:2]}"
    return f"DIFFER {len(got[1])}/{len(want[1])}{sample[:1500]}", took, sql_took, False


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("names", nargs="*")
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    args = ap.parse_args()
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.legacy.parquet.nanosAsLong": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = oracle(args.sf), []
    for name, (plan, statement) in all_queries().items():
        if args.names and not any(n in name for n in args.names):
            continue
        try:
            with run_folder(spark):
                verdict, took, sql_took, ok = compare(spark, con, name, plan, statement, args.sf)
        except Exception as exc:
            verdict, took, sql_took, ok = f"ERROR {type(exc).__name__}: {str(exc)[:900]}", 0, 0, False
        print(f"{name:32s} {took:6.2f}s {sql_took:6.2f}s  {verdict}", flush=True)
        if not ok:
            bad.append(name)
    print("failed:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
