"""Runs registered queries and their SQL side by side. Usage: python tests/check_sql.py SF_DIR [query ...]"""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents pages labels benchmark conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns and rows in a fixed order; NULL as None."""
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    keys = frame.map(repr)
    return frame.loc[keys.sort_values(list(keys.columns)).index].reset_index(drop=True)


def difference(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str | None:
    """What differs between two results, or None."""
    if sorted(spark_rows.columns) != sorted(sql_rows.columns):
        return f"columns {sorted(spark_rows.columns)} vs {sorted(sql_rows.columns)}"
    if len(spark_rows) != len(sql_rows):
        return f"{len(spark_rows)} rows vs {len(sql_rows)}"
    left, right = canonical(spark_rows), canonical(sql_rows)
    same = (left == right) | (left.isna() & right.isna())
    if same.all(axis=None):
        return None
    bad = ~same.all(axis=1)
    columns = [name for name in left.columns if not same[name].all()]
    return f"{bad.sum()} rows differ in {columns}\n{left[bad].head(3).to_string()}\n{right[bad].head(3).to_string()}"


def main(sf_dir: str, names: list[str]) -> int:
    from ledgerlane.session import local_session
    from __spark_entry__ import oracle_sql, queries

    spark, connection, failures = local_session(8), connect(sf_dir), 0
    spark.conf.set("spark.sql.session.timeZone", os.environ.get("CHECK_TIME_ZONE", "UTC"))
    statements = oracle_sql()
    for name, run in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        rows = run(spark, sf_dir).toPandas()
        seconds = time.time() - started
        if name not in statements:
            print(f"{name:36s} {len(rows):7d} {seconds:6.2f}s  no SQL")
            continue
        problem = difference(rows, connection.execute(statements[name]).df())
        failures += problem is not None
        print(f"{name:36s} {len(rows):7d} {seconds:6.2f}s  {'ok' if problem is None else 'DIFFERS ' + problem}")
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
