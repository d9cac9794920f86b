"""Run registered queries and their SQL side by side.

    python tests/oracle.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import pathlib
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, int):
        return float(value)
    if isinstance(value, dt.datetime | dt.date):
        return value.isoformat()
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """None when equal, else what differs."""
    result = query(spark, sf_dir)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(result.columns) != sorted(names):
        return f"columns {sorted(result.columns)} vs {sorted(names)}"
    ours = rows_of(result.columns, [tuple(r) for r in result.collect()])
    theirs = rows_of(names, cursor.fetchall())
    if ours == theirs:
        return None if ours else "both empty"
    only_ours, only_theirs = ours - theirs, theirs - ours
    return (
        f"{sum(ours.values())} vs {sum(theirs.values())} rows on {sorted(names)}\n"
        f"   spark only {sum(only_ours.values())}: {list(only_ours)[:2]}\n"
        f"   sql only {sum(only_theirs.values())}: {list(only_theirs)[:2]}"
    )


def main() -> None:
    import __spark_entry__ as contract
    from hazardbook.session import local_session

    args = sys.argv[1:]
    sf = "0.01"
    if args[:1] == ["--sf"]:
        sf, args = args[1], args[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = local_session(8), connect(sf_dir)
    queries, oracles = contract.queries(), contract.oracle_sql()
    failed = 0
    for name in args or list(queries):
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, sf_dir, queries[name], oracles[name])
            else:
                count = queries[name](spark, sf_dir).count()
                problem = None if count else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:500]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or ''}")
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
