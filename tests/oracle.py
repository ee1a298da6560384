"""Run a registered query and its comparison SQL, and compare the results row by row."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def compare(spark, con, sf, key, query, sql) -> str:
    """Empty text when equal, else what differs."""
    got = query(spark, sf)
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    if sorted(got.columns) != sorted(names):
        return f"columns {sorted(got.columns)} != {sorted(names)}"
    theirs = rows_of(names, want.fetchall())
    ours = rows_of(got.columns, [tuple(r) for r in got.collect()])
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    kinds = {n: k for n, k in got.dtypes}
    odd = [f"{n}:{k}" for n, k in kinds.items() if k in ("int", "float") or k.startswith("decimal")]
    for a, b in zip(ours, theirs):
        if a != b:
            return f"first difference: spark {a} != sql {b}"
    if not ours:
        return "no rows"
    return f"types {odd}" if odd else ""


def main() -> None:
    import __spark_entry__ as entry
    from tabml.session import local_session

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session()
    con = duck(sf)
    sqls = entry.oracle_sql()
    bad = 0
    for key, query in entry.queries().items():
        if wanted and not any(key.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if key in sqls:
                problem = compare(spark, con, sf, key, query, sqls[key])
            else:
                problem = "" if query(spark, sf).collect() else "no rows"
                key += " (rows only)"
        except Exception as e:  # show the failure and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += bool(problem)
        print(f"{'BAD' if problem else 'ok '} {key} {time.time() - start:.1f}s {problem}", flush=True)
    print("bad:", bad)
    spark.stop()


if __name__ == "__main__":
    main()
