"""Compare every registered query with its SQL: ``python -m workload.check <folder> [names]``."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter

import duckdb

from workload.oracle import SQL
from workload.queries import REGISTRY

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, decimal.Decimal)):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _rows(names, records) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in records)


def compare(spark, connection, folder: str, name: str) -> str | None:
    """None when both sides agree, else what differs."""
    df = REGISTRY[name](spark, folder)
    found = df.collect()
    wanted = connection.execute(SQL[name])
    names = [d[0] for d in wanted.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    ours, theirs = _rows(df.columns, found), _rows(names, wanted.fetchall())
    if ours == theirs:
        return None
    extra, missing = list((ours - theirs).items()), list((theirs - ours).items())
    return f"{len(found)} rows; only ours {extra[:2]}; only SQL {missing[:2]} ({len(extra)}/{len(missing)})"


def main(folder: str, names: list[str]) -> int:
    from millrace.session import get_session

    spark = get_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, failures = connect(folder), 0
    for name in names or SQL:
        start = time.time()
        try:
            problem = compare(spark, connection, folder, name)
        except Exception as error:  # a failing query is a finding, not the end of the check
            problem = f"{type(error).__name__}: {str(error)[:500]}"
        failures += problem is not None
        print(f"{name:34s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{failures} of {len(names or SQL)} differ; without SQL: {sorted(set(REGISTRY) - set(SQL))}")
    return failures


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
