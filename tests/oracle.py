"""Run registered queries against DuckDB and compare rows, names and types."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def connect(sf: str):
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return con


def compare(spark, con, query, sql: str, sf: str) -> str | None:
    """None if equal, else what differs."""
    frame = query(spark, sf)
    columns = sorted(frame.columns)
    relation = con.sql(sql)
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    if sorted(kinds) != columns:
        return f"columns {columns} / {sorted(kinds)}"
    got_types = {c: k for c, k in frame.dtypes}
    want_types = {c: TYPES.get(k, k) for c, k in kinds.items()}
    if got_types != want_types:
        return f"types {got_types} / {want_types}"
    got = Counter(tuple(r) for r in frame.select(*columns).collect())
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = Counter(con.sql(f"SELECT {quoted} FROM ({sql})").fetchall())
    if got != want:
        return (
            f"rows {sum(got.values())} / {sum(want.values())}; only here "
            f"{list((got - want).items())[:3]}; only there {list((want - got).items())[:3]}"
        )
    return None if got else "no rows"


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from catalogflow import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = build_session(
        master="local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name, query in entry.queries().items():
        if chosen and not any(c in name for c in chosen):
            continue
        started = time.time()
        try:
            result = compare(spark, con, query, entry.oracle_sql()[name], sf)
        except Exception as error:
            result = f"{type(error).__name__}: {str(error)[:600]}"
        bad += result is not None
        mark = "ok " if result is None else "BAD"
        print(f"{mark} {name} {time.time() - started:.2f}s {result or ''}", flush=True)
    print("failed:", bad)
