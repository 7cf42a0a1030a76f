"""Side-by-side check of queries against their SQL twins.

    python tests/compare.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _cell(v) -> str:
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "<null>"
    return str(v)


def canonical(rows, names: list[str]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, sf_dir: str, name: str, query, sql: str, con) -> tuple[int, str]:
    """(row count, problem); the problem is empty when both sides agree."""
    df = query(spark, sf_dir)
    mine = df.collect()
    result = con.execute(sql)
    theirs_names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    theirs = result.fetchall()
    if sorted(df.columns) != sorted(theirs_names):
        return len(mine), f"columns {sorted(df.columns)} != {sorted(theirs_names)}"
    a, b = canonical(mine, df.columns), canonical(theirs, theirs_names)
    if len(a) != len(b):
        return len(a), f"rows {len(a)} != {len(b)}"
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        return len(a), f"{len(diff)} rows differ, first {diff[0]}"
    wide = {f.name: f.dataType.simpleString() for f in df.schema}
    odd = [c for c in wide if wide[c] == "bigint" and "HUGE" in types[c].upper()]
    return len(a), f"types {odd}" if odd else ""


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from ledgerloom.session import build_session

    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="/root/testdata/sf0.01")
    args.add_argument("names", nargs="*")
    opts = args.parse_args()
    spark = build_session("compare", f"local[{os.environ.get('COMPARE_CPUS', '8')}]", {
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(opts.sf), oracle_sql(), 0
    for name, query in queries().items():
        if opts.names and name not in opts.names:
            continue
        start = time.time()
        try:
            if name in sqls:
                n, problem = compare(spark, opts.sf, name, query, sqls[name], con)
            else:
                n, problem = query(spark, opts.sf).count(), ""
        except Exception as e:  # a failing query must not hide the others
            n, problem = -1, f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(problem)
        kind = "" if name in sqls else " (rows only)"
        print(f"{'FAIL' if problem else 'ok  '} {name:24s} {n:7d} {time.time() - start:6.2f}s"
              f"{kind} {problem}", flush=True)
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
