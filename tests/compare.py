"""Run registered queries beside their SQL and compare schema, rows and values.

Usage: python tests/compare.py SF_DIR [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def canonical(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def kind(name: str) -> str:
    name = name.lower()
    if "int" in name:
        return "integer"
    return {"varchar": "string", "timestamp_ntz": "timestamp"}.get(name, name)


def difference(frame, sql: str, connection) -> tuple[str | None, int]:
    """None when the DataFrame and the SQL give the same columns, types and rows."""
    relation = connection.execute(sql)
    names = [column[0] for column in relation.description]
    types = {column[0]: str(column[1]) for column in relation.description}
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}", 0
    spark_types = dict(frame.dtypes)
    odd = [n for n in names if kind(spark_types[n]) != kind(types[n])]
    if odd:
        return "types " + ", ".join(f"{n}: {spark_types[n]} != {types[n]}" for n in odd), 0
    order = sorted(names)
    want = sorted(tuple(canonical(row[names.index(n)]) for n in order) for row in relation.fetchall())
    have = sorted(tuple(canonical(row[n]) for n in order) for row in frame.collect())
    if len(want) != len(have):
        only = set(have) ^ set(want)
        return f"{len(have)} rows != {len(want)}; e.g. {list(only)[:3]}", len(have)
    for left, right in zip(have, want):
        if left != right:
            return f"{dict(zip(order, left))} != {dict(zip(order, right))}", len(have)
    return None, len(have)


def main() -> int:
    from barledger.plans.oracle import ORACLES
    from barledger.plans.queries import REGISTRY
    from barledger.session import build_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:] or list(REGISTRY)
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="12g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in wanted:
        begin = time.time()
        try:
            fault, rows = difference(REGISTRY[name](spark, sf_dir), ORACLES[name], connection)
        except Exception as error:  # noqa: BLE001
            fault, rows = f"{type(error).__name__}: {str(error)[:1500]}", 0
        failed += fault is not None
        print(f"{name:28s} {rows:8d} {time.time() - begin:6.1f}s {fault or 'ok'}", flush=True)
    print(f"{len(wanted) - failed} of {len(wanted)} agree; without SQL: {sorted(set(REGISTRY) - set(ORACLES))}")
    return failed


if __name__ == "__main__":
    raise SystemExit(main())
