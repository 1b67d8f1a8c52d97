"""Compare every query with its SQL twin: ``python -m checks.compare [scale] [name …]``."""

from __future__ import annotations

import sys
import time

import duckdb

from checks import registry
from logwarden.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(repr(row[i]) for i in order) for row in rows))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def compare(spark, connection, sf_dir: str, name: str) -> str:
    """Empty when equal, else what differs."""
    df = registry.queries()[name](spark, sf_dir)
    got = normal([tuple(r) for r in df.collect()], df.columns)
    sql = registry.oracle_sql().get(name)
    if sql is None:
        return "" if got else "no rows"
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    want = normal(result.fetchall(), columns)
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got == want:
        return ""
    only_got = [r for r in got if r not in set(want)][:2]
    only_want = [r for r in want if r not in set(got)][:2]
    return f"{len(got)} rows != {len(want)} rows; only here {only_got}; only in SQL {only_want}"


def main(scale: str = "0.01", *names: str) -> int:
    sf_dir = f"/root/testdata/sf{scale}"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    failed = 0
    for name in names or registry.queries():
        start = time.time()
        try:
            difference = compare(spark, connection, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            difference = f"{type(error).__name__}: {str(error)[:800]}"
        failed += bool(difference)
        twin = "sql" if name in registry.oracle_sql() else "rows"
        print(f"{'FAIL' if difference else 'ok':4} {twin:4} {time.time() - start:6.1f}s {name} {difference[:900]}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
