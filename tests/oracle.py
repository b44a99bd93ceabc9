"""Compare registered queries with their check SQL.

Run as a script: ``python tests/oracle.py [folder] [name prefix ...]``.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from delaylens.sources.sample_tables import TABLES


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def canon(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    return f"{type(value).__name__}:{value!r}"


def canon_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canon(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, fn, sql: str, folder: str) -> str | None:
    """None when equal, else what differs."""
    df = fn(spark, folder)
    mine = canon_rows(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = canon_rows(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} / {len(theirs)}"
    differing = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(differing)} differ, first {differing[0]}" if differing else None


if __name__ == "__main__":
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from delaylens.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("oracle", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con, checks, failed = connect(folder), entry.oracle_sql(), []
    for name, fn in entry.queries().items():
        if len(sys.argv) > 2 and not name.startswith(tuple(sys.argv[2:])):
            continue
        begin = time.time()
        try:
            if name in checks:
                problem = compare(spark, con, name, fn, checks[name], folder)
            else:
                n = len(fn(spark, folder).collect())
                problem = None if n else "no rows"
        except Exception as error:  # report every query, then fail
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:40s} {time.time() - begin:6.2f}s {'ok' if problem is None else 'FAIL ' + problem}", flush=True)
        failed += [name] if problem else []
    print("failed:", failed)
