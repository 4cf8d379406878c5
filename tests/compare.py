"""Runs catalogue queries against their DuckDB SQL: python -m tests.compare [folder] [names]."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else (0.0 if value == 0 else value)
    return value


def rows_of(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, query, sql, folder) -> str:
    """Empty string if both give the same columns and rows, else what differs."""
    frame = query(spark, folder)
    got = rows_of(frame.columns, frame.collect())
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(frame.columns)} vs {sorted(columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    wrong = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(wrong)} of {len(got)} rows differ, first {wrong[0]}" if wrong else ""


def main() -> int:
    import __spark_entry__ as entry
    from txnlytics.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark, con = local_session(cores="8"), connect(folder)
    queries, oracles, failed = entry.queries(), entry.oracle_sql(), 0
    for name, query in queries.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, name, query, oracles[name], folder)
            else:
                problem = "" if query(spark, folder).count() else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        kind = "sql " if name in oracles else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name} {time.time() - start:.2f}s {problem}", flush=True)
    print("unmatched oracles:", set(oracles) - set(queries), "failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
