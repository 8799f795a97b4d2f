"""Compare the registered queries with their SQL on DuckDB.

    python tests/oracle_check.py [folder] [part of a query name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def compare(spark, con, query, sql, folder) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, folder)
    ours = normal([tuple(row) for row in df.collect()], df.columns)
    result = con.execute(sql)
    names = [item[0] for item in result.description]
    theirs = normal(result.fetchall(), names)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    unequal = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(unequal)} rows differ, first {unequal[0]}" if unequal else None


def main() -> int:
    from paywatch.contract.oracle import all_oracles
    from paywatch.contract.queries import all_queries
    from paywatch.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark, con = local_session(), database(folder)
    oracles, bad = all_oracles(), 0
    for name, query in all_queries().items():
        if parts and not any(part in name for part in parts):
            continue
        start = time.time()
        try:
            if name in oracles:
                outcome = compare(spark, con, query, oracles[name], folder) or "ok"
            else:
                outcome = f"{query(spark, folder).count()} rows, no SQL"
        except Exception as error:  # report and go on
            outcome = f"FAILED {type(error).__name__}: {str(error)[:400]}"
        bad += not (outcome == "ok" or outcome.endswith("no SQL"))
        print(f"{name:32s} {time.time() - start:6.2f}s {outcome}", flush=True)
    print(f"{bad} not equal")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
