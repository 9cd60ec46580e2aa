"""Run a registered query and its SQL on the same tables and compare whole results.

Command line: ``python -m tests.compare sf0.01 [name ...]``.
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, int):
        return float(v) if abs(v) < 2 ** 53 else v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i].lower())
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [names[i].lower() for i in order], sorted(out, key=lambda r: tuple((v is not None, str(v)) for v in r))


def check(spark, con, build, sql, sf_dir):
    """Problem text, or an empty string when the results are the same."""
    df = build(spark, sf_dir)
    a_names, a = rows_of(df.columns, df.collect())
    if sql is None:
        return "" if a else "no rows", len(a)
    cur = con.execute(sql)
    b_names, b = rows_of([d[0] for d in cur.description], cur.fetchall())
    if a_names != b_names:
        return f"columns {a_names} != {b_names}", len(a)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}", len(a)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, e.g. {bad[0]}", len(a)
    return ("" if a else "no rows"), len(a)


def main(argv: list[str]) -> int:
    from skycat.plans import queries as q
    from skycat.session import local_session

    sf_dir = f"{TESTDATA}/{argv[0] if argv else 'sf0.01'}"
    names = argv[1:] or list(q.QUERIES)
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in [n for n in q.QUERIES if any(n == w or (w.endswith("*") and n.startswith(w[:-1])) for w in names)]:
        start = time.time()
        try:
            problem, n = check(spark, con, q.QUERIES[name], q.ORACLES.get(name), sf_dir)
        except Exception as error:  # report and go on
            problem, n = f"{type(error).__name__}: {str(error)[:1500]}", -1
        failed += bool(problem)
        kind = "sql " if name in q.ORACLES else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name:34s} rows={n:<8d} {time.time() - start:6.1f}s {problem[:1800]}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1:])))
