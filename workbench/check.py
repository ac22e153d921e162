"""Run registered queries against DuckDB: python -m workbench.check [folder] [name ...]"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from workbench.registry import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, (list, tuple)):
        return tuple(plain(x) for x in value)
    return value


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def difference(spark, con, folder: str, name: str) -> str | None:
    """None if Spark and DuckDB agree on names, types and rows, else what differs."""
    df = QUERIES[name](spark, folder)
    got = canon(df.columns, [tuple(row) for row in df.collect()])
    if name not in ORACLES:
        return None if got[1] else "no rows"
    found = con.execute(ORACLES[name])
    want = canon([d[0] for d in found.description], found.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    if not got[1]:
        return "no rows"
    for a, b in zip(got[1], want[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} != {b}"
    return None


def main(folder: str, names: list[str]) -> int:
    from hitloom.session import local_session
    from workbench import catalog

    spark, con = local_session(8), connect(folder)
    bad = 0
    for name in names or list(catalog.QUERIES):
        start = time.time()
        try:
            problem = difference(spark, con, folder, name)
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        kind = "S" if name in ORACLES else "R"
        print(f"{time.time() - start:6.2f} {kind} {name}: {problem or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    args = sys.argv[1:] or ["/root/testdata/sf0.01"]
    raise SystemExit(main(args[0], args[1:]))
