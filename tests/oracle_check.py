"""Compare registered queries with their SQL: same columns, same rows, order aside."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(v := plain(row[i])).__name__, v) for i in order) for row in rows)


def differences(spark_frame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    cursor = connection.execute(sql)
    wanted_columns = [d[0] for d in cursor.description]
    wanted = bag(wanted_columns, cursor.fetchall())
    found_columns = spark_frame.columns
    if sorted(found_columns) != sorted(wanted_columns):
        return [f"columns {sorted(found_columns)} != {sorted(wanted_columns)}"]
    found = bag(found_columns, spark_frame.collect())
    if found == wanted:
        return []
    return [f"rows {sum(found.values())} vs {sum(wanted.values())}",
            f"only here {list((found - wanted).items())[:3]}",
            f"only in SQL {list((wanted - found).items())[:3]}"]
