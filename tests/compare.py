"""Compare registered queries with their SQL counterparts: ``python tests/compare.py [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as spark_entry  # noqa: E402
from ledgerline.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        if isinstance(value, float):
            return None if math.isnan(value) else (float(f"{value:.12g}") + 0.0)
        return value

    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, connection, name: str, sf_dir: str) -> tuple[bool, str]:
    frame = spark_entry.queries()[name](spark, sf_dir)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    sql = spark_entry.oracle_sql().get(name)
    if sql is None:
        return len(got) > 0, f"{len(got)} rows, no SQL"
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return False, f"columns differ: {sorted(frame.columns)} / {sorted(columns)}"
    if got != want:
        pairs = [(g, w) for g, w in zip(got, want) if g != w][:2]
        return False, f"{len(got)} rows / {len(want)} rows, first differences {pairs}"
    kinds = {type(v).__name__ for r in got[:200] for v in r}
    return True, f"{len(got)} rows {sorted(kinds)}"


if __name__ == "__main__":
    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    session = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    names = sys.argv[1:] or list(spark_entry.queries())
    views = duck(folder)
    bad = 0
    for query_name in names:
        started = time.time()
        try:
            good, note = compare(session, views, query_name, folder)
        except Exception as error:  # report and go on with the next query
            good, note = False, repr(error)[:1500]
        bad += not good
        print(f"{'ok  ' if good else 'FAIL'} {query_name} {time.time() - started:.1f}s {note}", flush=True)
    print(f"{len(names) - bad} of {len(names)} good")
