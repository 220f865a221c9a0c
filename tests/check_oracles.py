"""Run registered queries beside their SQL: python tests/check_oracles.py [sf_dir] [name ...]"""

from __future__ import annotations

import glob
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from quadloom.session import local_session  # noqa: E402


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def duck_rows(con, sql: str):
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    names = sorted(columns)
    at = [columns.index(n) for n in names]
    return names, sorted((tuple(r[i] for i in at) for r in found.fetchall()), key=repr)


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            got = spark_rows(fn(spark, sf_dir))
        except Exception as problem:
            bad += 1
            print(f"ERROR {name}: {str(problem)[:1500]}")
            continue
        took = time.time() - start
        if name not in oracles:
            print(f"rows  {name}: {len(got[1])} ({took:.1f}s)")
            continue
        try:
            want = duck_rows(con, oracles[name])
        except Exception as problem:
            bad += 1
            print(f"SQL   {name}: {str(problem)[:1500]}")
            continue
        if got == want:
            print(f"ok    {name}: {len(got[1])} ({took:.1f}s)")
            continue
        bad += 1
        print(f"DIFF  {name}: {len(got[1])} rows, SQL {len(want[1])}; {got[0]} {want[0]}")
        a, b = set(map(repr, got[1])), set(map(repr, want[1]))
        print("   only ours:", [x[:400] for x in sorted(a - b)[:2]])
        print("   only SQL: ", [x[:400] for x in sorted(b - a)[:2]])
    print("failed:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
