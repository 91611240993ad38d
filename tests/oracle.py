"""Runs registered queries beside their SQL: ``python -m tests.oracle [sf_dir] [name …]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from textloom.registry import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, con, folder: str, name: str) -> str | None:
    """A description of the first difference, or none."""
    df = QUERIES[name](spark, folder)
    got = _sorted(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return None if got[1] else "no rows"
    result = con.execute(ORACLES[name])
    types = {d[0]: str(d[1]) for d in result.description}
    want = _sorted([d[0] for d in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for column, kind in df.dtypes:
        if kinds.get(kind) != types[column]:
            return f"type of {column}: {kind} != {types[column]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b:
            return f"{str(a)[:300]} != {str(b)[:300]}"
    return None if got[1] else "no rows on both sides"


if __name__ == "__main__":
    from textloom.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    for name in names:
        start = time.time()
        try:
            outcome = compare(spark, con, folder, name) or "ok"
        except Exception as error:  # report and go on with the next query
            outcome = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:28s} {time.time() - start:6.2f}s {outcome}{'' if name in ORACLES else ' (no SQL)'}", flush=True)
