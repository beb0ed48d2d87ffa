"""Run registered queries in Spark and their SQL in DuckDB and compare the rows as multisets."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(_plain(r[i])).__name__, _plain(r[i])) for i in order) for r in rows)


def differences(spark, con, query, sql: str, sf_dir: str) -> list[str]:
    frame = query(spark, sf_dir)
    ours = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = _rows(names, cursor.fetchall())
    problems = []
    if sorted(names) != sorted(frame.columns):
        problems.append(f"columns {sorted(frame.columns)} != {sorted(names)}")
    if ours != theirs:
        problems.append(f"rows {sum(ours.values())} vs {sum(theirs.values())}")
        problems += [f"  only spark: {r}" for r in list((ours - theirs).elements())[:3]]
        problems += [f"  only sql:   {r}" for r in list((theirs - ours).elements())[:3]]
    if not ours:
        problems.append("no rows")
    return problems


if __name__ == "__main__":
    from quoteflow import session
    from quoteflow.plans import registry

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(registry.QUERIES)
    spark_, con_ = session.local(8), connect(sf)
    for name in wanted:
        started = time.time()
        try:
            if name in registry.ORACLE:
                found = differences(spark_, con_, registry.QUERIES[name], registry.ORACLE[name], sf)
            else:
                found = [] if registry.QUERIES[name](spark_, sf).count() else ["no rows"]
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        mark = "ok  " if not found else "FAIL"
        note = "" if name in registry.ORACLE else " (rows only)"
        print(f"{mark} {name} {time.time() - started:.1f}s{note}", *found, sep="\n     " if found else "")
