"""Run queries in Spark and DuckDB and compare columns, row counts and values.

    python tests/compare.py 0.01 [name ...]     (or a folder instead of the scale factor)
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, decimal.Decimal):
        return round(float(value), 6) + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def difference(df, connection, sql: str) -> str | None:
    """None when equal, else what differs."""
    left_columns, left = df.columns, df.collect()
    cursor = connection.execute(sql)
    right_columns, right = [d[0] for d in cursor.description], cursor.fetchall()
    if sorted(left_columns) != sorted(right_columns):
        return f"columns {sorted(left_columns)} vs {sorted(right_columns)}"
    a, b = _rows(left_columns, left), _rows(right_columns, right)
    if len(a) != len(b):
        return f"{len(a)} rows vs {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} of {len(a)} rows differ, first {wrong[0]}" if wrong else None


def main() -> int:
    import __spark_entry__ as entry
    from starbazaar.session import local_session

    sf_dir = sys.argv[1] if os.path.isdir(sys.argv[1]) else f"/root/testdata/sf{sys.argv[1]}"
    spark = local_session(8, **{"spark.sql.shuffle.partitions": "8"})
    connection, sql, failed = duck(sf_dir), entry.oracle_sql(), []
    for name, query in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        begin = time.perf_counter()
        try:
            df = query(spark, sf_dir)
            found = difference(df, connection, sql[name]) if name in sql else f"no oracle, {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:600]}"
        if found:
            failed.append(name)
        print(f"{'ok  ' if not found else 'FAIL'} {name:34} {time.perf_counter() - begin:6.2f}s {found or ''}", flush=True)
    print(f"{len(failed)} differ: {failed}")
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())
