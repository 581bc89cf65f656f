"""Run queries beside their oracles: python -m checks.compare [SF_DIR] [NAME...]"""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time
import traceback

import duckdb

from checks import oracles, queries
from shopsight.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def plain(value: object) -> object:
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime) and value.tzinfo is not None:
        return value.astimezone(datetime.timezone.utc).replace(tzinfo=None)
    return value


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


# Exact correspondence of result types; anything else counts as a mismatch.
KINDS = {
    "bigint": "bigint", "int": "int", "integer": "int", "double": "double", "string": "text",
    "varchar": "text", "timestamp": "time", "boolean": "bool", "date": "date",
}


def kinds(types: dict[str, str]) -> dict[str, str]:
    return {c: KINDS.get(t.lower(), t) for c, t in sorted(types.items())}


def compare(spark, connection, name: str, sf_dir: str) -> tuple[bool, str]:
    start = time.perf_counter()
    df = queries.build(name)(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    took = time.perf_counter() - start
    if name not in oracles.ORACLES:
        return len(rows) > 0, f"{took:6.2f}s {len(rows)} rows, no oracle"
    cursor = connection.execute(oracles.compose(name))
    oracle_types = {d[0]: str(d[1]) for d in cursor.description}
    expected = cursor.fetchall()
    ours = kinds(dict(df.dtypes))
    theirs = kinds(oracle_types)
    if ours != theirs:
        return False, f"schema: {set(ours.items()) ^ set(theirs.items())}"
    left = canonical(df.columns, rows)
    right = canonical(list(oracle_types), expected)
    if left != right:
        different = [(a, b) for a, b in zip(left, right) if a != b]
        return False, f"rows {len(left)} vs {len(right)}, {len(different)} differ, first: {different[:1]}"
    return True, f"{took:6.2f}s {len(rows)} rows"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries.QUERIES)
    spark = local_session("compare")
    connection = oracle_connection(sf_dir)
    failed = []
    for name in names:
        try:
            good, detail = compare(spark, connection, name, sf_dir)
        except Exception:
            good, detail = False, traceback.format_exc(limit=-3)[-1500:]
        if not good:
            failed.append(name)
        print(f"{'ok  ' if good else 'FAIL'} {name:28s} {detail}", flush=True)
    unknown = set(oracles.ORACLES) - set(queries.QUERIES)
    print(f"{len(names) - len(failed)}/{len(names)} ok; failed: {failed}; oracles without query: {sorted(unknown)}")
    return 1 if failed or unknown else 0


if __name__ == "__main__":
    sys.exit(main())
