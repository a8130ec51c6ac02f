"""Run the queries against their SQL on one scale: ``python tests/oracle_check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in at) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """None if both sides agree, else what differs."""
    df = query(spark, sf_dir)
    got_columns, got = df.columns, [tuple(r) for r in df.collect()]
    rel = con.execute(sql)
    want_columns, want = [d[0] for d in rel.description], rel.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} vs {sorted(want_columns)}"
    kinds = dict(df.dtypes)
    declared = {d[0]: str(d[1]).lower() for d in rel.description}
    same = {"bigint": "bigint", "string": "varchar", "boolean": "boolean", "double": "double", "int": "integer"}
    for c in got_columns:
        if same.get(kinds[c], kinds[c]) != declared[c]:
            return f"type of {c}: {kinds[c]} vs {declared[c]}"
    a, b = rows_of(got_columns, got), rows_of(want_columns, want)
    if len(a) != len(b):
        return f"{len(a)} rows vs {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"{str(x)[:400]}\n  vs {str(y)[:400]}"
    if not a:
        return "no rows on either side"
    return None


def main() -> None:
    from corpusprep.plans.catalog import QUERIES
    from corpusprep.plans.oracle import ORACLE
    from corpusprep.plans.round_trips import QUERIES as ROUND_TRIPS
    from corpusprep.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    queries = QUERIES | ROUND_TRIPS
    names = sys.argv[2:] or list(queries)
    spark, con = local_session(8), connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, queries[name], ORACLE[name])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
