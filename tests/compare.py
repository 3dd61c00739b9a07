"""Run a query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return int(value) if value == int(value) else float(value)
    if isinstance(value, float) and not math.isnan(value) and value == int(value):
        return int(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    return [columns[at] for at in order], Counter(tuple(_plain(row[at]) for at in order) for row in rows)


def difference(spark, connection, folder, run, sql) -> str | None:
    """None when both give the same columns and rows, else what differs."""
    frame = run(spark, folder)
    columns, mine = _rows(frame.columns, [tuple(row) for row in frame.collect()])
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    inexact = [d[0] for d in result.description if "HUGEINT" in str(d[1]) or "DECIMAL" in str(d[1])]
    inexact += [name for name, kind in frame.dtypes if kind.startswith("decimal")]
    if inexact:
        return f"columns without a common type: {inexact}"
    expected_columns, expected = _rows(names, result.fetchall())
    if columns != expected_columns:
        return f"columns {columns} instead of {expected_columns}"
    if mine != expected:
        extra, missing = list((mine - expected).elements()), list((expected - mine).elements())
        return f"{sum(mine.values())} rows instead of {sum(expected.values())}; extra {len(extra)} {extra[:3]}; missing {len(missing)} {missing[:3]}"
    return None if mine else "no rows"


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as entry
    from clausemill.session import local_session

    data = f"/root/testdata/{sys.argv[1]}"
    wanted = sys.argv[2:]
    session, database = local_session(), connect(data)
    oracles = entry.oracle_sql()
    for name, run in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        started = time.time()
        try:
            if name in oracles:
                problem = difference(session, database, data, run, oracles[name])
            else:
                problem = f"no SQL, {run(session, data).count()} rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:300]}"
        print(f"{name:34s} {time.time() - started:6.2f}s  {problem or 'ok'}", flush=True)
