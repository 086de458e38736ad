"""Compares registered queries with their SQL, column by column and row by row."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def rows_by_name(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def difference(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None if equal, else what differs."""
    frame = query(spark, sf_dir)
    ours = rows_by_name(frame.columns, (tuple(row) for row in frame.collect()))
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    theirs = rows_by_name(names, result.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    if ours != theirs:
        return (
            f"{sum(ours.values())} rows against {sum(theirs.values())}; only here "
            f"{list((ours - theirs).items())[:2]}; only there {list((theirs - ours).items())[:2]}"
        )
    return None


def main(sf_dir: str, keys: list[str]) -> None:
    import __spark_entry__ as contract
    from tallyproof.session import local_session

    spark, con = local_session(), connect(sf_dir)
    queries, oracle = contract.queries(), contract.oracle_sql()
    for key in keys or oracle:
        start = time.time()
        problem = difference(spark, con, queries[key], oracle[key], sf_dir)
        print(f"{key:28s} {time.time() - start:6.2f}s {problem or 'equal'}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
