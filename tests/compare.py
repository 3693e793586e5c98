"""Run every registered query beside its SQL and compare whole results.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events".split()


def sql_connection(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def normal(rows, columns):
    """Rows as sorted text, columns in name order; decimals without trailing zeros."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(value):
        if value is None:
            return "NULL"
        if hasattr(value, "normalize"):
            return format(value.normalize(), "f") if value else "0"
        return str(value)

    return [columns[i] for i in order], sorted("|".join(text(r[i]) for i in order) for r in rows)


def difference(name, spark, con, sf_dir) -> str | None:
    import __spark_entry__ as entry

    got = entry.queries()[name](spark, sf_dir)
    want = con.execute(entry.oracle_sql()[name])
    columns, rows = normal([tuple(r) for r in got.collect()], got.columns)
    names, expected = normal(want.fetchall(), [d[0] for d in want.description])
    if columns != names:
        return f"columns {columns} != {names}"
    if rows != expected:
        only = [r for r in rows if r not in set(expected)][:3]
        missing = [r for r in expected if r not in set(rows)][:3]
        return f"{len(rows)} rows, expected {len(expected)}; only here {only}; missing {missing}"
    return None


if __name__ == "__main__":
    from quintacube.session import local_session

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    session, connection = local_session(), sql_connection(folder)
    bad = 0
    for query in sys.argv[2:] or entry.queries():
        start = time.time()
        try:
            found = difference(query, session, connection, folder)
        except Exception as failure:  # noqa: BLE001 - report and go on with the next query
            found = f"{type(failure).__name__}: {str(failure)[:600]}"
        bad += found is not None
        print(f"{query:24} {time.time() - start:6.2f}s {found or 'ok'}", flush=True)
    print(f"{bad} differ")
