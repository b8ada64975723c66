"""Compare queries with their DuckDB SQL: ``python -m tests.oracle_check <sf_dir> [query ...]``."""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)
KINDS = {
    "TINYINT": "int", "SMALLINT": "int", "INTEGER": "int", "BIGINT": "bigint", "HUGEINT": "hugeint",
    "DOUBLE": "double", "FLOAT": "float", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, Decimal):
        return f"decimal {value}"
    return value


def _normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when names, types and all values agree, else a description of the first difference."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in result.description}
    theirs = _normal(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    types = dict(df.dtypes)
    wrong = {c: (types[c], kinds[c]) for c in names if types[c] != kinds[c]}
    if wrong:
        return f"types {wrong}"
    ours = _normal(df.columns, df.collect())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows vs {len(theirs)}"
    different = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if different:
        return f"{len(different)} of {len(ours)} rows differ, e.g.\n   {different[0][0]}\n   {different[0][1]}"
    return None


def main() -> int:
    import __spark_entry__ as contract
    from tests.conftest import make_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, con = make_session(), connect(sf_dir)
    failed = 0
    for name, build in contract.queries().items():
        sql = contract.oracle_sql().get(name)
        if sql is None or (names and name not in names):
            continue
        started = time.monotonic()
        problem = compare(build(spark, sf_dir), con, sql)
        failed += problem is not None
        print(f"{name:26s} {time.monotonic() - started:6.2f}s {problem or 'ok'}", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
