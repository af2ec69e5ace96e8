"""Side-by-side runs of a query and its SQL.

    python -m tests.compare [sf_dir] [query ...]
"""

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            connection.execute(
                f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
            )
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


SPARK_TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def difference(df, connection, sql: str) -> str | None:
    """None when both give the same columns, types and rows; otherwise what differs first."""
    result = connection.sql(sql)
    theirs_types = dict(zip(result.columns, map(str, result.types)))
    ours_types = {name: SPARK_TYPES.get(kind, kind) for name, kind in df.dtypes}
    if ours_types != theirs_types:
        return f"types: {sorted(ours_types.items())} != {sorted(theirs_types.items())}"
    names, ours = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    _, theirs = _sorted_rows(list(result.columns), result.fetchall())
    if len(ours) != len(theirs):
        return f"rows: {len(ours)} != {len(theirs)}"
    for left, right in zip(ours, theirs):
        if left != right:
            return f"{names}\n  spark {left}\n  sql   {right}"
    return None


def main() -> int:
    from tests.conftest import local_session
    from tillgrain.plans.catalog import QUERIES
    from tillgrain.plans.oracle import ORACLE

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session()
    connection = connect(sf_dir)
    failed = 0
    for name in names:
        started = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLE:
                problem = difference(df, connection, ORACLE[name])
            else:
                problem = None if df.collect() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{time.time() - started:6.2f}s {'ok  ' if problem is None else 'FAIL'} {name}", flush=True)
        if problem:
            print("   ", problem, flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
