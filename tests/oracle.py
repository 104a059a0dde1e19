"""Compare every query with its SQL: `python tests/oracle.py [sf_dir] [query ...]`."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def normal(value):
    if value is None or value != value:
        return None
    if isinstance(value, bool) or type(value).__name__ == "bool_":
        return bool(value)
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return round(value, 6)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def expected(sf_dir: str, sql: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    cur = con.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()


def differences(df, sf_dir: str, name: str) -> str | None:
    """None when the query's result and its SQL agree, else what differs."""
    from meterspark import catalog
    got = df.collect()
    if name not in catalog.oracle_sql():
        return None if got else "no rows"
    columns, want = expected(sf_dir, catalog.oracle_sql()[name])
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    a, b = rows_of(df.columns, got), rows_of(columns, want)
    if a == b:
        return None if a else "both empty"
    only_a, only_b = [r for r in a if r not in set(b)][:3], [r for r in b if r not in set(a)][:3]
    return f"{len(a)} rows != {len(b)} rows; ours {only_a}; expected {only_b}"


if __name__ == "__main__":
    from conftest import make_session
    from meterspark import catalog
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = make_session()
    for query in sys.argv[2:] or catalog.queries():
        started = time.time()
        try:
            problem = differences(catalog.queries()[query](spark, sf), sf, query)
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        print(f"{time.time() - started:6.1f}s {query}: {problem or 'ok'}", flush=True)
