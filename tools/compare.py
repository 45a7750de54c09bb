"""Run registered queries in Spark and their SQL twins in DuckDB, compare.

    python tools/compare.py [--sf 0.01] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import datetime
import glob
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from pyspark.sql import SparkSession

from harborline.queries import ORACLE, QUERIES


def norm(v):
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return str(v) if v is not None and not isinstance(v, (int, str)) else v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return ([columns[i] for i in order],
            sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr))


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("names", nargs="*")
    ap.add_argument("--sf", default="0.01")
    args = ap.parse_args()
    root = f"/root/testdata/sf{args.sf}"
    # A session with Spark's defaults: results must not depend on ours.
    spark = (SparkSession.builder.master("local[8]").appName("compare")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for p in glob.glob(root + "/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    bad = 0
    for name in QUERIES:
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        t = time.time()
        try:
            df = QUERIES[name](spark, root)
            cols, got = rows_of(df.columns, df.collect())
            took = time.time() - t
            if name not in ORACLE:
                print(f"rows {name:28s} {len(got):7d} rows {took:6.2f}s (no SQL)", flush=True)
                continue
            rel = con.execute(ORACLE[name])
            dcols, want = rows_of([d[0] for d in rel.description], rel.fetchall())
            if cols != dcols:
                bad += 1
                print(f"COLS {name}: spark {cols} sql {dcols}", flush=True)
            elif got != want:
                bad += 1
                print(f"DIFF {name}: {len(got)} vs {len(want)} rows; cols {cols}")
                gs, ws = set(got), set(want)
                for side, xs in (("spark", sorted(gs - ws, key=repr)[:3]),
                                 ("sql", sorted(ws - gs, key=repr)[:3])):
                    for x in xs:
                        print("   ", side, str(x)[:600])
                sys.stdout.flush()
            else:
                print(f"ok   {name:28s} {len(got):7d} rows {took:6.2f}s", flush=True)
        except Exception as e:
            bad += 1
            print(f"FAIL {name}: {type(e).__name__} {str(e)[:700]}", flush=True)
            if os.environ.get("TB"):
                traceback.print_exc()
    print("bad:", bad)
    spark.stop()


main()
